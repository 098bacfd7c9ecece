"""The corpus operators against brute force, and on nulls, ties and empty tables."""

import hashlib
import itertools
import re
import warnings
import zlib

import numpy as np
import pytest

import corpus_pipeline
from trip_marts.llm import bpe, components, html_main, imatch, minhash, mixing, quality, secret_scan, textarrays, token_files, toxicity, vector_dedup
from trip_marts.llm.shared import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is that for it was on are with as by this be at from an"


def text_of(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("aeinorstlh"), rng.integers(2, 7))) for _ in range(n))


LONG = text_of(1, 30000)
ODD = [None, "", "   ", "one", "x" * 3000, LONG, text_of(2, 40), text_of(2, 40), text_of(2, 40).upper(), "é ü 日本 😀 it's"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows, a repeated row and a column whose name clashes with results."""
    ship(spark)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)]
    rows += [rows[6], (None, "no id here", None, None, None)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as score", "7 as component_id", "'y' as ids")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_secrets_equal_plain_matching(spark, docs):
    texts = [
        'password = "abcdef12" and SECRET:zzzzzz, token=abc', "AKIA" + "A1" * 8 + " AKIAX " + "AKIA" + "B" * 30,
        "0123456789abcdef01234567 x " + "f" * 23, "api_key='k/+=._-9' apikey: 123456", "ſecret=abcdef", None,
        "ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----",
    ]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = by_id(secret_scan.digest(made))
    for i, text in enumerate(texts):
        spans = []
        for k, rule in enumerate(secret_scan.BASE_RULES):
            own = [m for m in re.finditer(rule.pattern, text or "") if len(m[rule.group]) >= rule.least]
            assert found[i][f"n_{rule.kind}"] == len(own)
            spans += [(m.start(), k, rule.kind, m.end()) for m in own]
        line = ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(spans))
        assert found[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
    assert "github:0" in found[6].spans and "private_key:0" in found[7].spans
    assert len(secret_scan.digest(docs).collect()) == docs.count()


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]+") is True
    assert secret_scan.trigram_query("AKIA[A-Z]+") == ("and", [b"aki", b"kia"])
    kind, options = secret_scan.trigram_query("ab(cd|ef)g")
    assert kind == "or" and len(options) == 2


def test_redaction_keeps_the_rest(spark):
    rows = [(1, "a password=abcdefgh b", "en", "s", 21), (2, None, None, None, None), (3, "clean", "en", "s", 5)]
    found = by_id(secret_scan.redact(spark.createDataFrame(rows, DOCS)))
    assert found[1].text == "a [REDACTED] b" and found[1].n_chars == 14
    assert found[2].text is None and found[3].text == "clean"


def components_of(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200), (7, 3)]
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in found} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_minhash_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = text_of(9, 60).split()
    texts = []
    for _ in range(60):  # a chain of growing edits: many members of one bucket aren't linked
        base = list(base)
        base[rng.integers(len(base))] = f"w{rng.integers(1000)}"
        texts.append(" ".join(base))
    texts += [None, "", " ", "one", "One", *[texts[0]] * 30]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80))

    def shingles(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return set(itertools.pairwise(words)) if len(words) > 1 else {tuple(words)} if words else set()

    sets = [shingles(t) for t in texts]
    linked = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {i: r.component_id for i, r in found.items()} == components_of(range(len(texts)), linked)
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(found[i].kept == (found[i].component_id == i) for i in found)


def test_blocks_join_only_what_is_similar():
    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in (0, 5, 300, 302, 1000)]
    links = minhash.joining_links(np.arange(5), np.arange(5), np.zeros(5, int), sets, 80)
    assert components_of(range(5), links) == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


def test_every_coordinate_of_a_sketch_is_filled():
    rows = minhash.sketch([np.array([5], np.uint64), np.arange(2000, dtype=np.uint64), np.zeros(0, np.uint64)])
    assert (rows[:2] != minhash._EMPTY).all() and (rows[2] == minhash._EMPTY).all()
    shares = []
    for k in range(20):
        a, b = (np.sort(textarrays.mix(np.arange(k * 5000 + lo, k * 5000 + lo + 1000, dtype=np.uint64))) for lo in (0, 200))
        same = minhash.sketch([a, b])
        shares.append((same[0] == same[1]).mean())
    assert abs(np.mean(shares) - 800 / 1200) < 0.04  # four standard errors


def test_duplicates_leave_one_of_each_group(spark, docs):
    kept = minhash.without_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 6, 9] and ids.count(None) == 1


def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CHUNK", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = [(centres[i % 6] + rng.normal(size=16) * (0.25 if i % 2 else 0.02)).astype(np.float32).tolist() for i in range(150)]
    rows += [rows[0]] * 20 + [[2 * x for x in rows[0]], [0.0] * 16, None, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 0.0], [1.0, 0.1]]
    made = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in vector_dedup.near_vectors(made).collect()}
    linked = []
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = rows[a], rows[b]
        if x and y and len(x) == len(y) and None not in x + y and np.isfinite(x + y).all() and any(x) and any(y):
            x, y = np.array(x), np.array(y)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                linked.append((a, b))
    degree = np.bincount(np.array(linked).ravel(), minlength=len(rows))
    assert [found[i].n_links for i in range(len(rows))] == degree.tolist()
    assert {i: r.component_id for i, r in found.items()} == components_of(range(len(rows)), linked)
    assert vector_dedup.near_vectors(made.limit(0)).count() == 0


def test_bpe_equals_the_library(spark, docs):
    import base64

    import public_tokenizers
    import tiktoken

    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(bpe.default_ranks())
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("'s'tremvldaZ 9  \n\t!é½ 日"), rng.integers(0, 25))) for _ in range(800)]
    texts += ["", "''s 's\n's", "they're  I'LL x ", "a" * 400, " " * 300, LONG]
    for _ in range(2):  # the second time from the cache
        ids, at = codec.encode(texts)
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(at)] == [library.encode_ordinary(t) for t in texts]
    encoded = bpe.encode(docs, bpe.default_ranks())
    back = {r.doc_id: bytes(r.text).decode() for r in bpe.decode(encoded, bpe.default_ranks()).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(ODD))
    assert by_id(bpe.digest(docs, bpe.default_ranks()))[9].decoded_sha256 == hashlib.sha256(ODD[9].encode()).hexdigest()


def test_token_files_round_trip(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.default_tokenizer())
    texts = [*ODD[:4], "A.. b, C. <|endoftext|>, É. don't.", LONG[:5000]]
    made = spark.createDataFrame([(5 * i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    start = 0
    for i, row in sorted(by_id(token_files.round_trip(made, token_files.default_tokenizer())).items()):
        ids = np.array([*library.encode(texts[i // 5] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    path = token_files.write_files(made, token_files.default_tokenizer())
    whole = {r.doc_id: r.ids for r in token_files.read_back(spark, path).collect()}
    some = {r.doc_id: r.ids for r in token_files.read_some(spark, path, [5, 20, 25, 7]).collect()}
    assert some == {i: whole[i] for i in (5, 20, 25)}
    broken = spark.read.parquet(f"{path}/table").withColumn("part", quality.F.col("part") + 1)
    broken.write.parquet(f"{path}/other/table")
    with pytest.raises(ValueError, match="damaged frequency table"):
        token_files.read_table(spark, f"{path}/other")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}/bad/table")
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("words_crc", quality.F.col("words_crc") + 1)
    blocks.write.parquet(f"{path}/bad/blocks")
    with pytest.raises(Exception, match="damaged words"):
        token_files.read_back(spark, f"{path}/bad").collect()
    assert token_files.round_trip(made.limit(0), token_files.default_tokenizer()).count() == 0
    assert token_files.round_trip(docs, token_files.default_tokenizer()).count() == docs.count()


def test_words_equal_the_library():
    words = token_files.WordTokenizer(token_files.default_tokenizer(), most=4000)  # the cache is emptied now and then
    rng = np.random.default_rng(12)
    letters = [*"aZ.,'s 9\n\té<İ\u0958\u0301kK-", "<|endoftext|>", "<|ENDOFTEXT|>", " x.", " ab, ", "...", "\xa0", "\u0f43.", "\u0a33."]
    for _ in range(3):
        texts = ["".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(3000)] + ["", "a", "A.", "."]
        ids, at = words.encode(texts)
        library = [e.ids for e in words.library.encode_batch_fast(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(at)] == library
    assert len(words.encode([])[0]) == 0


def thue_morse(n):
    """Two words that polynomials modulo 2**64 cannot tell apart."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_words_of_equal_polynomials_stay_apart():
    a, b = thue_morse(12)
    _, hashes = textarrays.words([f"{a} {b} {a.upper()}", "x" * 8, "x" * 9, "x" * 8 + " xx"])
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 5 and hashes[3] == hashes[5]
    one, two = minhash.shingle_sets([a, b], 1)
    assert one[0] != two[0]
    codec = bpe.Codec(bpe.default_ranks())
    ids, at = codec.encode([a, b, a])
    assert codec.decode(ids)[0].decode() == a + b + a


def test_slices_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(textarrays, "byte_hashes", lambda data, lo, hi: np.zeros(len(lo), np.uint64))
    data = np.frombuffer(b"abcdabceabcdab", np.uint8)
    lo, hi = np.array([0, 4, 8, 12, 0]), np.array([4, 8, 12, 14, 2])
    which, unique = textarrays.distinct_slices(data, lo, hi)
    assert which[0] == which[2] and which[3] == which[4] and len(unique) == 3


def test_parts_of_a_block_decode_alone():
    ids = np.random.default_rng(6).zipf(1.3, 300_000) % 5000
    coder = token_files.Coder(token_files.Frequencies.of_counts(np.bincount(ids)))
    words, states, marks = coder.encode(ids)
    assert (coder.decode(words, states, marks, len(ids)) == ids).all()
    size = token_files.CHECK_STEPS * token_files.LANES
    assert (coder.decode(words, states, marks, len(ids), 2, 3) == ids[2 * size : 3 * size]).all()


#: A filter that is full.
EVERY_TERM = np.full(1, (1 << 64) - 1, np.uint64)


def test_fingerprints_follow_the_order_of_ids(spark, docs):
    found = by_id(imatch.edit_digest(docs.where("doc_id is not null").dropDuplicates(["doc_id"])))
    for i, text in enumerate(ODD):
        changed = imatch.edited(text or "", ODD[(i + 1) % len(ODD)] or "")
        assert found[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    assert found[6].fingerprint == found[7].fingerprint == found[8].fingerprint
    assert imatch.edit_digest(docs).count() == docs.count() and imatch.edit_digest(docs.limit(0)).count() == 0


def test_an_edited_text_stays_nearer_than_another():
    printer = imatch.Printer(imatch.Lexicon(np.zeros(0, np.uint64), EVERY_TERM))
    pairs = [(text_of(k, 300), text_of(k + 500, 300)) for k in range(20)]
    for text, other in pairs:
        own, changed, far = printer.prints([text, imatch.edited(text, other), other])
        assert imatch.likeness(own, own) == 1 and imatch.likeness(own, changed) > imatch.likeness(own, far)


def test_terms_of_one_text_are_left_out(spark):
    ship(spark)
    texts = [text_of(k, 30) + f" own{k}" for k in range(60)]
    rows = [(i, texts[i % 60] if i < 120 else texts[0], "en", "s", 0) for i in range(180)]  # copies of all, many of one
    band = imatch.lexicon(spark.createDataFrame([*rows, (999, None, "en", "s", 0)], DOCS).repartition(5, "doc_id"))
    sets = [set(own.tolist()) for own in imatch.terms(texts)]
    held = {t: sum(t in own for own in sets) for t in set().union(*sets)}
    within = dict(zip(held, band.inside(np.array(list(held), np.uint64)).tolist()))
    assert all(within[t] for t, n in held.items() if 1 < n <= 0.05 * 61)
    assert not any(within[t] for t, n in held.items() if n > 0.05 * 61)
    rare = [within[t] for t, n in held.items() if n == 1]
    assert len(rare) >= 60 and sum(rare) <= 0.1 * len(rare)  # false positives of the filter
    printer = imatch.Printer(band)
    typo = texts[0].replace("own0", "zzzz9")
    own, changed = printer.prints([texts[0], typo])
    assert {k: v for k, v in own.items() if k[0] < imatch.ALL_TERMS} == {k: v for k, v in changed.items() if k[0] < imatch.ALL_TERMS}
    nothing = imatch.lexicon(spark.createDataFrame([], DOCS))
    assert len(nothing.common) == 0 and not nothing.repeated.any()


def test_fingerprints_equal_a_plain_loop():
    def mixed(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor % (1 << 64)
        return x ^ x >> 31

    for n in (0, 1, 2, 7, 40, 300):
        own = imatch.terms([text_of(n, n)])[0]
        expected = {}
        first = max(0, len(own).bit_length() - 2)
        for level in (first, first + 1, first + 2) if len(own) else ():
            for k in range(imatch.SUBSETS):
                salt = mixed((k + 1) * 0x5851F42D4C957F2D % (1 << 64))
                kept = [t for t in own.tolist() if level == 0 or mixed((t + salt) % (1 << 64)) < (1 << 64) - 1 >> level]
                if kept:
                    data = b"".join(t.to_bytes(8, "little") for t in sorted(kept))
                    expected[level, k] = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")
        assert imatch.fingerprint(own) == expected


def test_a_full_filter_leaves_no_rare_term_out():
    own = imatch.terms([text_of(1, 50)])[0]
    assert imatch.Lexicon(np.zeros(0, np.uint64), EVERY_TERM).inside(own).all()
    assert not imatch.Lexicon(np.zeros(0, np.uint64), np.zeros(64, np.uint64)).inside(own).any()


def test_copies_make_no_term_common(spark):
    ship(spark)
    texts = [text_of(k, 60) for k in range(40)]
    rows = [(i, texts[i] if i < 40 else texts[0], "en", "s", 0) for i in range(60)]  # a third is one text
    made = spark.createDataFrame(rows, DOCS).repartition(4, "doc_id")
    sets = [set(own.tolist()) for own in imatch.terms(texts)]
    held = {t: sum(t in own for own in sets) for t in set().union(*sets)}
    assert sorted(t for t, n in held.items() if n > 0.05 * 40) == imatch.lexicon(made).common.tolist()
    found = by_id(imatch.edit_digest(made))
    assert all(found[i].fingerprint for i in range(60)) and len({found[i].fingerprint for i in range(40)}) == 40
    assert all(found[i].near_edited > found[i].near_next for i in range(39))
    few = by_id(imatch.edit_digest(made.where("doc_id < 10")))  # every term is above the share
    assert len({few[i].fingerprint for i in range(10)} - {""}) == 10 and all(few[i].near_edited > few[i].near_next for i in range(10))
    printer = imatch.Printer(imatch.Lexicon(imatch.terms([texts[0]])[0], EVERY_TERM))  # no term inside the band
    own, changed, far = printer.prints([texts[0], imatch.edited(texts[0], texts[1]), texts[2]])
    assert imatch.likeness(own, changed) > imatch.likeness(own, far)


def test_classifiers_learn_and_read_no_held_out_label(spark):
    good = [(i, text_of(i, 80), "en", "s", 0) for i in range(120)]
    bad = [(i, " ".join(w.upper() + "!!" for w in text_of(i, 80).split()), "en", "s", 0) for i in range(120, 180)]
    toxic = [(i, text_of(i, 60) + " you idiot", "en", "s", 0) for i in range(180, 260)]
    made = spark.createDataFrame(good + bad + toxic, DOCS)
    labels = spark.createDataFrame([(i, int(not 120 <= i < 180), int(i >= 180)) for i in range(260)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for op, fold, outside, name in ((quality, 5, 0, "quality"), (toxicity, 4, 2, "toxic")):
        seen = labels.where(quality.fold(fold) != outside)
        model = op.train(made, seen)
        scores = by_id(op.score(made, model))
        truth = {r.doc_id: r[name] for r in labels.where(f"{name} is not null and doc_id is not null").collect()}
        assert np.mean([(scores[i].score >= 0.3) == bool(truth[i]) for i in truth]) > 0.95
        turned = labels.withColumn(name, quality.F.when(quality.fold(fold) == outside, 1 - quality.F.col(name)).otherwise(quality.F.col(name)))
        again = by_id(op.score(made, op.train(made, turned)))
        assert all(abs(again[i].score - scores[i].score) < 1e-6 for i in truth)
        empty = op.train(made, labels.limit(0))
        assert {r.score for r in op.score(made, empty).collect()} == {0.5}


def test_scores_equal_a_plain_loop():
    texts = ["", "  ", "Ab ab the the the é", "x", text_of(3, 12), "日本 日本 no"]
    weights = np.random.default_rng(2).normal(0, 1, quality.BUCKETS)
    model = quality.Model(weights, 0.25)

    def word_hash(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return textarrays.byte_hashes(data, np.array([0]), np.array([len(data)]))

    for text, found in zip(texts, model.scores(texts)):
        own = ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        places = [quality.bucket_of(word_hash(w), quality.BUCKETS)[0] for w in own]
        places += [quality.bucket_of(quality._TWICE, quality.BUCKETS)[0] for a, b in zip(own, own[1:]) if a == b]
        for n in quality.GRAMS:
            for gram in (text[i : i + n] for i in range(len(text) - n + 1)):
                sums = textarrays.prefix_sums(np.array([ord(c) for c in gram], np.uint32))
                places.append(quality.bucket_of(textarrays.slice_hashes(sums, np.array([0]), np.array([n])), quality.BUCKETS, n)[0])
        mean = sum(weights[p] for p in places) / max(len(places), 1)
        assert abs(found - 1 / (1 + np.exp(-(mean + 0.25)))) < 1e-9


def test_scores_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(6, 1, 0), (9, 0, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    for op in (quality, toxicity):
        model = op.train(docs, labels)
        rows = op.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert op.score(docs.limit(0), model).count() == 0
    assert set(quality.accepted(docs, quality.Model(np.zeros(quality.BUCKETS), 0.0)).columns) == set(docs.columns)


def test_deobfuscation():
    words = "you are such an idiot and moron this is worthless trash said the loser to him".split()
    s = " ".join(words * 50)
    points = toxicity.symbol(np.array([ord(c) for c in s]))
    grams = (points[:-2] * 64 + points[1:-1]) * 64 + points[2:]
    restorer = toxicity.Restorer(toxicity.Language.of_counts(np.bincount(grams, minlength=64**3)))
    read = {
        "you 1d10t": "you idiot", "i d i o t": "idiot", "such a m0r0n!!": "such a moron!!", "w-o-r-t-h-l-e-s-s": "worthless",
        "looooser": "loser", "fine words, 5 of them": "fine words, 5 of them", "": "", "you idi0+": "you idiot", "tra5#": "trash",
        "idio+ and mor0n.": "idiot and moron.", "i  d  i  o  t": "idiot", "i d i o t, you": "idiot, you", "an i. d. i. o. t!": "an idiot!",
        "rows 1 2 3 and 5 - 3 - 1": "rows 1 2 3 and 5 - 3 - 1",
    }
    assert dict(zip(read, restorer.restore(list(read)))) == read
    rng = np.random.default_rng(6)
    for n in range(300):
        text = "".join(rng.choice(list("idtors105$+!  .-aa"), rng.integers(1, 8)))
        # every place at which the pattern matches is found beforehand
        assert restorer.restore([f"{text} x", text]) == [toxicity.SUSPICIOUS.sub(restorer._replaced, s) for s in (f"{text} x", text)]
        gaps = toxicity._ALL_SPACED.fullmatch(text) is not None
        costs: dict = {}
        for path in itertools.product(*(restorer.options(text, i, gaps) for i in range(len(text)))):
            reading = "".join(c for c, _ in path)
            symbols = [0, 0, *map(toxicity._symbol_of, reading), 0]
            cost = sum(c for _, c in path) + sum(float(restorer.costs[a, b, c]) for a, b, c in zip(symbols, symbols[1:], symbols[2:]))
            costs[reading] = min(cost, costs.get(reading, np.inf))
        assert costs[restorer.decode(text)] <= min(costs.values()) + 1e-6, text


def test_long_stretches_are_decoded():
    words = "you are such an idiot and moron this is worthless trash said the loser to him".split()
    points = toxicity.symbol(np.array([ord(c) for c in " ".join(words * 50)]))
    grams = (points[:-2] * 64 + points[1:-1]) * 64 + points[2:]
    restorer = toxicity.Restorer(toxicity.Language.of_counts(np.bincount(grams, minlength=64**3)))
    letters = "youaresuchanidiotandmoronthisisworthlesstrashsaidtheloser" * 4
    assert len(letters) > 200
    (read,) = restorer.restore([" ".join(letters)])
    assert read.replace(" ", "") == letters and "idiot" in read and "worthless" in read
    assert restorer.restore(["l" + "o" * 90 + "ser", "x" * 50_000])[0] == "loser"


def test_mixing_meets_the_targets(spark, docs):
    rng = np.random.default_rng(8)
    kinds = {"aa": "abcde", "bb": "vwxyz"}
    rows = []
    for i in range(300):
        lang = "aa" if i % 4 else "bb"
        t = " ".join("".join(rng.choice(list(kinds[lang]), 5)) for _ in range(30))
        rows.append((i, t, lang, "s", len(t)))
    how = mixing.Mixing(targets={"aa": 0.5, "bb": 0.5})
    found = mixing.rates(spark.createDataFrame(rows, DOCS), how).collect()
    totals = np.sum([np.array(r.posteriors) * r.n_tokens * r.rate for r in found], axis=0)
    assert abs(totals[0] / totals.sum() - 0.5) < 0.01 and min(r.rate for r in found) >= 0
    assert len(mixing.rates(docs).collect()) == docs.count()
    assert mixing.rates(docs.limit(0)).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


def test_mixing_with_a_document_of_a_third_of_the_tokens(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    soft = np.column_stack([rng.uniform(0.0, 0.02, 300), np.zeros(300)])
    soft[::4, 0] = rng.uniform(0.97, 1.0, 75)
    soft[:, 1] = 1 - soft[:, 0]
    model = mixing.Classifier(["aa", "bb"], None, None)

    def planned(soft, tokens, targets):
        rows = [(int(t), p.tolist()) for t, p in zip(tokens, soft)]
        plan = mixing.fit(spark.createDataFrame(rows, "n_tokens long, posteriors array<double>").repartition(4), model, mixing.Mixing(targets=targets))
        expected = (plan.rates(tokens, soft) * tokens) @ soft / tokens.sum()
        return plan, expected

    tokens = np.full(300, 200)
    for large in ([1], [0], [1, 2, 3, 5, 6]):
        tokens[large] = 30_000 // len(large)
        for share in (0.5, 0.9):
            plan, expected = planned(soft, tokens, {"aa": share, "bb": 1 - share})
            assert plan.met and np.abs(expected - [share, 1 - share]).max() <= 1e-3 * max(share, 1 - share)
        tokens[large] = 200
    with pytest.warns(UserWarning, match="cannot be met"):
        plan, expected = planned(np.clip(soft, 0.3, 0.7), tokens, {"aa": 0.9, "bb": 0.1})
    assert not plan.met and abs(plan.residual - np.abs(expected - [0.9, 0.1]).max()) < 1e-6


def test_mixing_equals_plain_least_squares(spark):
    ship(spark)
    rng = np.random.default_rng(12)
    for k, low in ((2, 0.3), (3, 0.2)):
        soft = np.maximum(rng.dirichlet(np.ones(k) * 0.4, 200), low)
        soft /= soft.sum(axis=1, keepdims=True)
        tokens = rng.integers(1, 400, 200)
        names = [f"d{i}" for i in range(k)]
        far = np.array([1 - 0.02 * (k - 1)] + [0.02] * (k - 1))  # no rates reach these
        rows = spark.createDataFrame([(int(t), p.tolist()) for t, p in zip(tokens, soft)], "n_tokens long, posteriors array<double>")
        parts = soft * (tokens / tokens.sum())[:, None]
        for targets in (far, parts.sum(axis=0)[::-1] / parts.sum()):
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                plan = mixing.fit(rows.repartition(3), mixing.Classifier(names, None, None), mixing.Mixing(targets=dict(zip(names, targets))))
            rate = np.ones(200)
            largest = np.linalg.norm(soft.T @ parts, 2)
            for _ in range(100_000):
                rate = np.maximum(0, rate - soft @ (rate @ parts - targets) / largest)
            best, own = np.linalg.norm(rate @ parts - targets), np.linalg.norm(plan.rates(tokens, soft) @ parts - targets)
            assert own <= best * 1.005 + 1e-3 * targets.max(), (k, best, own)


def test_mixing_keeps_a_rare_domain(spark):
    ship(spark)
    rng = np.random.default_rng(5)
    kinds = {"aa": "abcde", "bb": "vwxyz", "cc": "klmno"}

    def row(i, lang):
        return i, " ".join("".join(rng.choice(list(kinds[lang]), 5)) for _ in range(20)), lang, "s", 0

    rows = [row(i, "aa" if i % 4 else "bb") for i in range(3000)] + [row(3000, "aa")] * 1000 + [row(i, "cc") for i in range(4000, 4003)]
    rows += [(9000, " ", "dd", "s", 0), (9001, None, "ee", "s", 0)]
    made = spark.createDataFrame(rows, DOCS).repartition(4, "doc_id")
    how = mixing.Mixing(targets={"aa": 0.5, "bb": 0.3, "cc": 0.2}, sample=300)
    assert mixing.train(made, how).domains == ["aa", "bb", "cc"]
    found = mixing.rates(made, how).collect()
    kind = {r[0]: r[2] for r in rows}
    mass = {lang: sum(r.n_tokens * r.rate for r in found if kind[r.doc_id] == lang) for lang in kinds}
    assert abs(mass["cc"] / sum(mass.values()) - 0.2) < 0.04, mass


PAGE = (
    '<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now.</div>'
    "<article><h1>Title &amp; more</h1><p><b>First</b> part,<br>with words that go on.<p>Second part, and more words in it.</article>"
    "<div class=comments><p>I liked it, really.</p></div><footer>&copy; x</footer><script>var t='</p>';</script></body></html>"
)


def test_main_text_of_pages(spark):
    rows = [(i, f"u{i}", PAGE.replace("words", text_of(i, 5 + i % 9))) for i in range(60)]
    rows += [(60, None, None), (61, "u", ""), (62, "u", "no markup at all"), (63, "u", "<p>cut off <b>her")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    found = {r.page_id: r for r in html_main.extract(pages, html_main.train(pages)).collect()}
    for i in range(60):
        words = text_of(i, 5 + i % 9)
        assert found[i].text == f"Title & more First part, with {words} that go on. Second part, and more {words} in it."
        assert found[i].n_chars == len(found[i].text)
    assert found[60].text == "" and found[61].text == "" and len(found) == 64
    none = pages.limit(0)
    assert html_main.extract(none, html_main.train(none)).count() == 0


def test_copies_of_a_page_train_once(spark):
    ship(spark)
    htmls = [PAGE.replace("words", text_of(i, 5)) for i in range(60)]
    made = spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    how = html_main.Training(sample=20)
    ranked = [r.html for r in made.orderBy(quality.F.xxhash64("html")).collect()]
    copies = spark.createDataFrame([(100 + i, "u", ranked[0]) for i in range(30)], made.schema)  # a third of the rows, first by hash
    found = [r.html for r in html_main.sampled(made.union(copies), how).collect()]
    assert sorted(found) == sorted(ranked[:20])
    assert html_main.sampled(made.limit(0), how).count() == 0


def test_broken_markup_drops_no_text():
    def text(source):
        return " ".join(t for _, t, _ in html_main.parse(source).blocks)

    for tag in ("button", "select", "svg", "object", "canvas", "template", "iframe", "noscript"):
        article = "<article><p>First part.</p><p>More of it.</p></article>"
        assert text(f"<body><header><{tag}></header>{article}<footer>End <{tag}>out</{tag}>.</footer></body>") == "First part. More of it. End ."
        assert text(f"<body><{tag} a=1>{article}") == "First part. More of it."
        assert text(f"<p>a <{tag}>out</{tag}> b</p>") == "a b"
    assert text("<p>a<svg><svg><path d='1'></svg>out</svg> b<button>x<p>c<button>out</button></p>") == "a bx c"
    assert text("<p title=Bob's>First words here.</p><p>it's more.</p>") == "First words here. it's more."
    assert text("<p title='a>b' class = \"c>d\" data-x=y=\"z>First.</p><p id=it's>More.</p>") == "First. More."
    assert text("<p>a<script>var t='</p><p>';</script>b</p><style>out") == "ab"


def test_decoding_contradicts_nobody():
    page = html_main.parse("<div><div><p>a</p><p>b</p></div><div><p>c</p></div></div>")
    rng = np.random.default_rng(9)
    for _ in range(20):
        kept = html_main.decode(page, rng.random(len(page.tags)))
        assert all(kept[page.parents[i]] for i in range(1, len(kept)) if kept[i])


def test_decoding_equals_the_best_labels():
    sources = ["<div>x<p>a</p><p>b<ul><li>c</li>d</ul></div>", "<p>a", "a<p>b</p>c", "<div><div>a<p>b</div>c</div><nav>d</nav>"]
    rng = np.random.default_rng(10)
    for source in sources * 50:
        page = html_main.parse(source)
        tied, p = html_main.sole(page), rng.random(len(page.tags))
        best, found = -np.inf, None
        for labels in itertools.product((True, False), repeat=len(p) - 1):
            own = np.array([True, *labels])
            up = own[page.parents[1:]]
            if (own[1:] & ~up).any() or (tied[1:] & (own[1:] != up)).any():
                continue
            value = np.where(own, np.log(p), np.log(1 - p))[~tied].sum()
            if value > best:
                best, found = value, own
        assert html_main.decode(page, p).tolist() == found.tolist()


def test_unnamed_blocks_beside_the_main_text(spark):
    ship(spark)
    article = lambda i: PAGE.replace("words", text_of(i, 5 + i % 9)).replace("<p>Second", f"<p>{text_of(i + 90, 30)}, so. It goes on.<p>Second")
    made = spark.createDataFrame([(i, f"u{i}", article(i)) for i in range(60)], "page_id long, url string, html string")
    model = html_main.train(made)
    said = "<p>I liked it, really. Thanks.</p><p>Me too.</p>"
    turns = {
        "unknown name": lambda h: h.replace("</article>", f"</article><div class=zq>{said}</div>"),
        "camel case": lambda h: h.replace("</article>", f"<div class=readerComments>{said}</div></article>"),
        "notice": lambda h: h.replace("<article>", '<div class="gdpr-overlay">We keep cookies, as you know.</div><article>'),
        "loose text": lambda h: h.replace("<body>", "<body>Cookie notice"),
        "loose text before the page": lambda h: "Cookie notice" + h,
        "other attributes": lambda h: h.replace("<p>", '<p title="a comment" style="color:red">'),
    }
    for i in (61, 65, 70):
        plain = html_main.main_text(article(i), model)
        assert plain.startswith("Title & more First part") and plain.endswith("more " + text_of(i, 5 + i % 9) + " in it.")
        for name, turn in turns.items():
            assert turn(article(i)) != article(i) and html_main.main_text(turn(article(i)), model) == plain, name
    assert html_main.main_text("no markup at all", model) == "no markup at all"


def test_pipeline_stages(spark, tmp_path):
    good = [(i, text_of(i, 80), "en", "s", 0) for i in range(60)]
    bad = [(i, " ".join(w.upper() + "!!" for w in text_of(i, 80).split()), "en", "s", 0) for i in range(60, 90)]
    rows = good + bad + [(90, good[0][1] + " tail", "en", "s", 0), (91, text_of(91, 50) + " password=abcdefgh1", "en", "s", 0), (92, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 60), 0) for i in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"s{number}"))
        docs = spark.read.parquet(str(tmp_path / f"s{number}"))
        kept.append({r.doc_id for r in docs.collect()})
        assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == corpus_pipeline.COLUMNS
    assert kept[0] >= {*range(60), 90, 91} and not kept[0] & set(range(60, 90))
    assert kept[0] - kept[1] == {90}
    redacted = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "s2")).collect()}
    assert redacted[91].endswith("[REDACTED]")
    assert kept[4] == kept[3] and corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()

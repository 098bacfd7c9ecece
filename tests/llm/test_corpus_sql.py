"""Corpus queries against their SQL: on the test tables, and on rows planted for it."""

import math
from collections import Counter

import numpy as np
import pytest

from driver_queries.compare import connect_oracle
from trip_marts.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def same(spark, sf_dir: str, name: str) -> list[tuple]:
    """Rows of a query, which must be those of its SQL."""
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    oracle = connect_oracle(sf_dir)
    assert sorted(r[0] for r in oracle.execute(f"DESCRIBE {ORACLE[name]}").fetchall()) == columns
    rows = list(map(tuple, result.select(*columns).collect()))
    expected = oracle.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert Counter(rows) == Counter(expected)
    return rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_corpus_query_equals_its_sql(spark, name):
    assert set(ORACLE) <= set(QUERIES)
    assert same(spark, SF, name)


def test_planted_vectors_equal_the_sql(spark, tmp_path):
    rng = np.random.default_rng(8)
    near, rows = rng.normal(size=(20, 8)), []
    for i in range(120):
        v = near[i % 20] + rng.normal(size=8) * rng.choice([0.05, 0.3, 0.6])
        rows.append((i, [float(x) for x in v.astype(np.float32)]))
    rows += [(120, rows[3][1]), (121, [2 * x for x in rows[3][1]]), (122, None), (123, [0.0] * 8), (124, [math.nan] + [1.0] * 7), (125, [math.inf] * 8)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").toPandas().to_parquet(str(tmp_path / "embeddings.parquet"))
    found = same(spark, str(tmp_path), "op2_embedding_near_dedup")
    assert sum(not r[1] for r in found) > 30


def test_planted_texts_equal_the_sql(spark, tmp_path):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for k in range(20):
        base = list(rng.choice(words, 40))
        for _ in range(4):
            rows.append((len(rows), " ".join(base)))
            base[rng.integers(40)] = "Edited"
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \t", "One", "one", "one two", "ONE\ntwo", rows[0][1]])]
    spark.createDataFrame(rows, "doc_id long, text string").toPandas().to_parquet(str(tmp_path / "documents.parquet"))
    found = same(spark, str(tmp_path), "op8_minhash_near_dedup")
    assert sum(not r[2] for r in found) > 20

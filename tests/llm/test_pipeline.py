"""The pipeline and the registered queries, against plain versions of each stage."""

from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline as cp
from pyspark.sql import functions as F
from tallybook.llm import registry
from tests.llm.test_jaccard_join import brute_force

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage returns, from the first on."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for _, stage in cp.STAGES:
        docs = cp.checkpointed(stage(spark, docs, SF_DIR))
        found.append(docs)
    return found


def test_order_and_columns(stages):
    assert [name for name, _ in cp.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns and after.count() > 0


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_near_duplicates_against_all_pairs(stages):
    given, kept = texts(stages[1]), texts(stages[2])
    expected = {i for i, (_, component) in brute_force(list(given.items())).items() if i == component}
    assert set(kept) == expected


def test_decontamination_against_plain_search(spark, stages):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    plain = lambda t: " ".join(t.lower().split())
    given, kept = texts(stages[2]), texts(stages[3])
    for i, text in given.items():
        if any(plain(r["text"]) in plain(text) for r in items):
            assert i not in kept
        elif i not in kept:
            spans = [plain(r["text"]).split() for r in items]
            assert any(
                " ".join(s[k : k + 8]) in plain(text) for s in spans for k in range(len(s) - 7)
            )


def test_mixing_repeats_rows_and_sharding_places_them(stages):
    given, mixed = texts(stages[3]), Counter(r["doc_id"] for r in stages[4].collect())
    assert set(mixed) <= set(given) and max(mixed.values()) <= 3
    shards = stages[5].collect()
    assert Counter(r["doc_id"] for r in shards) == mixed
    loads = Counter(r["shard"] for r in shards)
    assert max(loads.values()) - min(loads[s] for s in range(16)) <= 1


def test_odd_rows_pass_every_stage(spark, odd, no_rows):
    for docs in (odd, no_rows):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF_DIR)
            if name != "sharding":
                assert out.columns == docs.columns
                assert dict(out.dtypes) == dict(docs.dtypes)
            assert (out.count() == 0) == (docs.count() == 0)


def test_columns_of_any_name_pass_every_stage(spark):
    rows = [(i, f"text number {i} has words", "a" if i % 2 else None, "en", 3) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    names = ["place", "rate", "floor", "turn", "tilt", "cuts", "_source", "s", "given", "size", "copies", "taken",
             "target", "source_size", "leak", "_leak", "_hash", "_key", "text_key", "_toxicity", "_copy", "key"]
    docs = docs.withColumns({name: F.lit(name) for name in names})
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert all(r[n] == n for r in out.collect() for n in names), name


def test_of_rows_with_one_id_the_smallest_text_hash_stays(spark):
    rows = [(1, f"the words of text {i} are not those of any other one {i}{i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [cp.near_duplicates(spark, docs.repartition(n), SF_DIR).collect() for n in (1, 4)]
    assert kept[0] == kept[1] and len(kept[0]) == 1


def test_registered():
    names = [name for name in contract.queries() if name[:2] == "op"]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(names) and "pipeline" in contract.queries()

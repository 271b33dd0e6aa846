"""The stages beside the operators' own results, and the registered queries."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare
from rostermart.llm import decontaminate, mix_sources, near_dedup, quality_net, toxic_neighbours
from rostermart.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute


def test_stages_follow_their_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "mixing"]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    def staged(k, df):
        from rostermart.sources.scratch import saved

        out = saved(corpus_pipeline.STAGES[k][1](spark, df, sf_dir), "stage")
        assert k == 4 or out.columns == df.columns
        return out

    kept = staged(0, docs)
    assert ids(kept) == ids(toxic_neighbours.judged(docs, labels).where("predicted = 0"))
    good = staged(1, kept)
    assert ids(good) == ids(quality_net.judged(kept, labels).where("predicted = 1"))
    single = staged(2, good)
    texts = {r.doc_id: r.text for r in good.collect()}
    low = brute.grouped(texts, 5, 80)
    assert ids(single) == sorted(i for i in texts if low[i] == i)
    clean = staged(3, single)
    assert ids(clean) == ids(decontaminate.find_contamination(single, benchmark).where("n_hit = 0"))
    mixed = staged(4, clean)
    assert ids(mixed) == ids(clean)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mix_sources.taken(mix_sources.mix_sources(clean)).collect()))
    assert near_dedup.deduplicate(single).count() == single.count()


def test_all_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_beside_its_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    assert compare(spark, db, name, sf_dir)[0] == "same"

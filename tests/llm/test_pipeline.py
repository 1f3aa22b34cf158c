import pytest

import __spark_entry__ as entry
import corpus_pipeline
from spanledger.llm import mixing, simhash
from spanledger.llm.registry import ORACLE, QUERIES
from spanledger.llm.simhash import keep_one_of_each, near_duplicates
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    con = connect(SF)
    assert compare(spark, con, SF, name).startswith("ok")


def test_registration():
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert len(corpus_pipeline.STAGES) == 5


def test_one_of_each_group_stays(spark):
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(9, text, "a"), (3, text, "b"), (3, text, "c"), (None, text, "d"), (None, "other words here", "e"), (None, "other words here", "e"), (4, None, "f"), (5, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").coalesce(1)
    got = keep_one_of_each(docs)
    assert got.columns == docs.columns
    ids = sorted((repr(r.doc_id), (r.text or "")[:5]) for r in got.collect())
    assert ids == sorted([("3", "word0"), ("None", "other"), ("4", "")])
    assert keep_one_of_each(docs.limit(0)).count() == 0


def test_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "bpe":
            assert out.columns[:2] == ["doc_id", "n_tokens"] and out.count() == docs.count()
            break
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near duplicates":
            want = {r.doc_id for r in near_duplicates(docs).filter("doc_id = component_id").collect()}
            assert {r.doc_id for r in out.collect()} == want
        if name == "secrets":
            assert out.filter("text LIKE '%token = \"0%'").count() == 0 and out.count() == docs.count()
        if name == "mixing":
            assert out.select("doc_id").distinct().count() == docs.count()
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert 0 < docs.select("doc_id").distinct().count() < before


def dealt_anew_after(monkeypatch, spark, module, name):
    """After the module's function ``name`` ran, reads of files are dealt over many more tasks, as on a cluster that grew."""
    inner = getattr(module, name)

    def run(*args):
        out = inner(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        return out

    monkeypatch.setattr(module, name, run)


def test_reads_dealt_anew_change_nothing(spark, tmp_path, monkeypatch):
    rows = [(k, " ".join(f"word{(k // 3) * 50 + n}" for n in range(40)), "ab"[k % 5 == 0]) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6, "doc_id")
    docs.write.option("parquet.block.size", 4096).parquet(str(tmp_path / "docs"))
    target = mixing.MixTarget(entropy=0.98, blocks=4)
    kept = lambda: sorted(r.doc_id for r in simhash.keep_one_of_each(spark.read.parquet(str(tmp_path / "docs"))).collect())
    mixed = lambda: sorted(
        (r.doc_id, r.mix_copies) for r in mixing.mix_sources(spark.read.parquet(str(tmp_path / "docs")), target).collect()
    )
    want_kept, want_mixed = kept(), mixed()
    assert want_kept == [k for k in range(300) if k % 3 == 0]
    for module, name, run, want in ((simhash, "_classes", kept, want_kept), (mixing, "source_plan", mixed, want_mixed)):
        try:
            dealt_anew_after(monkeypatch, spark, module, name)
            assert run() == want, name
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
            monkeypatch.undo()

"""The pipeline's stages on planted cases, and the registered queries against their SQL."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA, duck, sorted_rows
from llm_fixtures import SCHEMA, nothing, odd, odd_rows, prose, rows_from  # noqa: F401

import __spark_entry__ as contract
from strata.llm import queries


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_queries_are_registered():
    names = contract.queries()
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_with_sql_match_it(spark, name):
    root = TESTDATA / "sf0.01"
    df = queries.QUERIES[name](spark, str(root))
    result = duck(root).execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.select(*names).collect()) == sorted_rows(result.fetchall())


def planted(tmp_path, spark):
    rng = random.Random(11)
    vocabulary = [f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(600)]
    clean = [prose(rng, 120, vocabulary) for _ in range(30)]
    item = prose(rng, 25, vocabulary)
    passage = "\n".join(prose(rng, 25, vocabulary) for _ in range(4))
    w = clean[0].split()
    w[50] = "changed"
    texts = clean + [clean[1], " ".join(w)]  # 30: a copy, 31: a near copy
    texts += [prose(rng, 60, vocabulary) + " " + item + " " + prose(rng, 60, vocabulary)]  # 32: a test item
    texts += [prose(rng, 60, vocabulary) + "\n" + passage + "\n" + prose(rng, 60, vocabulary) for _ in range(3)]  # 33 to 35
    texts += ["BUY!! NOW!! " * 60, "x$$$ y### z%%% " * 50, "same " * 200]  # 36 to 38: junk
    docs = spark.createDataFrame(rows_from(texts), SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return texts, passage


def test_decisions_of_the_stages(spark, tmp_path):
    texts, passage = planted(tmp_path, spark)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(36))
    lines = stages["line_dedup"](spark, docs, str(tmp_path))
    assert [r.doc_id for r in lines.collect() if passage in r.text] == [33]
    near = stages["near_duplicates"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in near.collect()) == [k for k in range(39) if k not in (30, 31)]
    pure = stages["decontamination"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in pure.collect()) == [k for k in range(39) if k != 32]
    for out in (kept, lines, near, pure):
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result} == set(range(30)) | {33, 34, 35}


def test_run_on_test_data(spark):
    rows = corpus_pipeline.run(spark, str(TESTDATA / "sf0.001")).collect()
    assert 100 < len({r.doc_id for r in rows}) < 200
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_every_stage_takes_odd_rows_and_empty_tables(spark, odd, nothing, tmp_path):
    spark.createDataFrame([(1, "zzz yyy"), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns, name
        assert 0 < out.count() <= len(odd_rows()), name
        assert stage(spark, nothing, str(tmp_path)).count() == 0, name
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, odd, str(tmp_path)).where("piece = 0").count() == len(odd_rows())
    assert stage(spark, nothing, str(tmp_path)).count() == 0


def test_stages_hand_texts_to_python_in_small_batches(spark, tmp_path):
    from conftest import spark_conf

    from strata.llm.session import BATCH_BYTES

    planted(tmp_path, spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(k, "some words " * 2000) for k in range(1500)], "doc_id long, text string").coalesce(1)

    def largest():
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"b": [x.nbytes]}) for x in batches), "b long")
        return max(r.b for r in sizes.collect())

    with spark_conf(spark, {name: "64m"}):
        assert largest() > 4 * BATCH_BYTES
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(name)
            stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
            assert largest() < 1.1 * BATCH_BYTES
        spark.conf.set(name, "9m")  # the session's own word holds
        corpus_pipeline.packing_stage(spark, docs, str(tmp_path))
        assert spark.conf.get(name) == "9m"


def plain_pipeline(spark, rows, items):
    """What is left of each document before packing: brute force, stage by stage (the classifier has its own plain version)."""
    import test_decontaminate
    import test_line_dedup
    import test_near_dup
    import test_passages

    from strata.llm import quality

    verdict = {r.doc_id: r.kept for r in quality.op1_quality_classifier(spark.createDataFrame(rows_from([t for _, t in rows]), SCHEMA)).collect()}
    docs = [(k, t) for k, t in rows if verdict[k]]
    docs = [(k, t) for k, (t, _) in test_line_dedup.brute(docs).items()]
    kept = test_near_dup.brute_classes(docs)
    docs = [(k, t) for k, t in docs if kept[k] == k]
    docs = [(k, t) for k, t in docs if not next(iter(test_decontaminate.brute([(k, t)], items)))[-1]]
    return test_passages.brute(docs, 50)


def test_equals_a_plain_version(spark, tmp_path):
    from tokenizers import Tokenizer

    from strata.llm import tokens

    texts, _ = planted(tmp_path, spark)
    rows = list(enumerate(texts))
    items = [tuple(r) for r in spark.read.parquet(str(tmp_path / "benchmark.parquet")).select("item_id", "text").collect()]
    left = plain_pipeline(spark, rows, items)
    t = Tokenizer.from_str(tokens.vocabulary())
    want = {k: [*t.encode(x, add_special_tokens=False).ids, 2] for k, x in left.items()}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(r.ids, dtype="<u2")
        assert len(ids) == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        assert len(got.setdefault(r.doc_id, [])) == r.start
        got[r.doc_id] += ids.tolist()
    assert got == want
    places = sorted((r.sequence_id, r.offset, r.length) for r in pieces)
    for (a, x, n), (b, y, _) in zip(places, places[1:]):
        assert (y == x + n) if a == b else y == 0
    assert all(x + n <= 1024 for _, x, n in places)


def test_stage_folders_are_deleted(spark, tmp_path):
    from pathlib import Path

    from strata.llm.session import shared_folder

    planted(tmp_path, spark)
    home = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in home.parent.glob("*/pipeline-*")} | {p.name for p in home.glob("pipeline-*")}
    rows = corpus_pipeline.run(spark, str(tmp_path))
    after = {p.name for p in home.parent.glob("*/pipeline-*")} | {p.name for p in home.glob("pipeline-*")}
    assert after <= before and rows.count() > 0


def test_a_cluster_must_name_a_shared_folder(spark, monkeypatch):
    from strata.llm import session

    class Context:
        master = "yarn"

        class _jsc:
            @staticmethod
            def sc():
                class Scala:
                    @staticmethod
                    def getCheckpointDir():
                        class Nothing:
                            isEmpty = staticmethod(lambda: True)

                        return Nothing

                return Scala

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session)

"""Chat rotation and the license scan against their SQL on tables full of edge cases, and the pipeline's stages."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm.chat import rotate
from riskweave.llm.licenses import TEMPLATES, anchors, scan, template_terms, weights
from riskweave.llm.queries import ORACLES

TURNS = [(1, 0, "system", "Be kind."), (1, 1, "anna", "Hello"), (1, 2, "ben", "Hi 😀"), (1, 3, "anna", None), (1, 3, "anna", "again"),
         (1, 3, "anna", "again"), (2, 0, "system", "alone"), (3, None, None, "x"), (3, 5, "bot", ""), (None, 1, "u", "lost"),
         (4, 100, "u", "far"), (4, 300, "a", "farther"), (4, 301, "u", "<|end|>"), (5, 0, "user", "y" * 50_000)]


def _rows(df, columns):
    plain = lambda x: None if pd.isna(x) else x if isinstance(x, (str, bool)) else int(x)
    return sorted(str(tuple(map(plain, r))) for r in df[columns].itertuples(index=False, name=None))


def test_rotation_against_sql(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as perspective", "1 as part")
    got = rotate(turns).withColumn("mask", F.array_join(F.transform("spans", lambda s: F.concat(
        s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")).drop("spans").toPandas()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(TURNS, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(ORACLES["op5_chat_rotation"]).df()
    assert _rows(got, sorted(want.columns)) == _rows(want, sorted(want.columns))
    for r in rotate(turns).collect():  # a span is what the assistant says, with the end mark
        for s in r["spans"]:
            assert r["text"][:s["start"]].endswith("<|assistant|>\n") and r["text"][s["start"]:s["stop"]].endswith("<|end|>")
    assert not any(r["conv_id"] == 2 for r in rotate(turns).collect())
    assert rotate(turns.limit(0)).collect() == []


FILES = [(1, "a", "en", "Licensed under the Apache License, Version 2.0."), (2, "a", "en", "plain text\nReleased under the MIT License.\nmore"),
         (3, "a", "en", "nothing here"), (4, "a", "de", None), (5, "b", "en", ""), (6, None, "en", "under the license of words"),
         (7, "a", "en", "nothing " * 20_000), (7, "a", "en", "other row of the same file"), (8, "a/c", "en", "deep"),
         (9, "a", "fr", "this is free and unencumbered software released into the public domain!")]


def test_scan_against_sql(spark):
    docs = pd.DataFrame(FILES, columns=["doc_id", "source", "lang", "text"])
    frame = spark.createDataFrame(FILES, "id long, source string, lang string, text string").selectExpr(
        "id", "concat(source, '/', lang, '/', id) as path", "text", "'x' as license", "0 as n")
    got = scan(frame).withColumnRenamed("id", "doc_id").toPandas()
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(ORACLES["op9_license_scan"]).df()
    assert _rows(got, sorted(want.columns)) == _rows(want, sorted(want.columns))
    by = {(r.doc_id, r.path): r for r in got.itertuples()}
    assert by[1, "a/en/1"].found == "file" and by[3, "a/en/3"].found == "inherited" and by[2, "a/en/2"].license == "MIT"
    assert pd.isna(by[4, "a/de/4"].license)
    assert scan(frame.limit(0)).collect() == []


def test_root_file_speaks_for_all_below(spark):
    files = [(0, "LICENSE", "Released under the MIT License."), (1, "x/y/z.py", "code"), (2, None, "code"), (3, "x/LICENSE", TEMPLATES[0][1]),
             (4, "w.py", "code")]
    got = {r["id"]: (r["license"], r["found"], r["from_dir"]) for r in scan(
        spark.createDataFrame(files, "id long, path string, text string")).collect()}
    assert got == {0: ("MIT", "file", None), 1: ("Apache-2.0", "inherited", "x"), 2: (None, None, None),
                   3: ("Apache-2.0", "file", None), 4: ("MIT", "inherited", "")}


def test_no_line_without_an_anchor_can_reach_the_limit(spark):
    idf, other = weights(spark.createDataFrame([("the license is under a version",), ("the public",)], "text string"), TEMPLATES)
    marks = set(anchors(idf, TEMPLATES, 0.6))
    for held in template_terms(TEMPLATES).values():
        rest = sum((n * idf[w]) ** 2 for w, n in held.items() if w not in marks)
        assert rest < 0.36 * sum((n * idf[w]) ** 2 for w, n in held.items())
    assert other == max(idf.values())


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """sf0.001 with edge rows and clashing columns, as a folder of tables."""
    folder = tmp_path_factory.mktemp("tables")
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    more = pd.DataFrame({"doc_id": [90_001, 90_002, 90_002, 90_003], "text": [None, "", "", docs.text[0]], "lang": [None, "en", "en", "en"],
                         "source": [None, "s", "s", "s"], "n_chars": [0, 0, 0, 0]})
    docs = pd.concat([docs, more], ignore_index=True).assign(row=5, score=0.5, whole="w", label=1, predicted=1, keep=False)
    docs.to_parquet(folder / "documents.parquet")
    pd.read_parquet("/root/testdata/sf0.001/labels.parquet").to_parquet(folder / "labels.parquet")
    return str(folder), docs


def test_pipeline_stages(spark, small):
    folder, table = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality classifier", "n-gram Jaccard join", "packing"]
    from riskweave.llm.kneser_ney import quality
    from riskweave.llm.ngram_join import near_duplicates
    from riskweave.llm.toxicity import toxicity
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    one = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert one.columns == docs.columns
    assert ids(one) == ids(toxicity(docs, labels).filter("predicted = 0"))
    two = corpus_pipeline.keep_quality(spark, docs, folder)
    assert two.columns == docs.columns and ids(two) == ids(quality(docs, labels).filter("keep"))
    three = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert three.columns == docs.columns
    classes = {r["class_id"] for r in near_duplicates(docs).collect()}
    kept = ids(three)
    assert sorted(classes) == kept and 0 in kept and 90_003 not in kept and kept.count(90_001) == 1 and 90_002 not in kept
    assert corpus_pipeline.pack_documents(spark, three, folder).agg(F.countDistinct("doc_id")).first()[0] == len(kept)


def test_pipeline_runs(spark, small):
    folder, table = small
    got = corpus_pipeline.run(spark, folder).toPandas()
    assert set(got.doc_id) <= set(table.doc_id) and len(got) > 50
    assert got.groupby("sequence_id")["length"].sum().max() <= 4096

"""Page, chunk and identifier semantics that the tables cannot show."""

import pandas as pd
from pyspark.sql import functions as F

from weftline.functions import ids as idf
from weftline.functions import text as tx
from weftline.operators import chunks, harvest, pages


def one(spark, column, text, kind="string"):
    return spark.createDataFrame([(text,)], f"t {kind}").select(column(F.col("t")).alias("x")).first()["x"]


def test_inline_noise(spark):
    assert one(spark, tx.strip_inline_noise, "a\n3 of 12\nb\n==> picture [1 x 2] intentionally omitted <==\nc\n\n\n\nd") == "a\nb\nc\n\nd"
    assert one(spark, tx.strip_inline_noise, None) is None


def test_page_classes(spark):
    long = "word " * 60
    cases = {
        "short": "near_blank",
        "No part of this work may be reproduced " + long: "legal_boilerplate",
        "# Contents\n" + long: "toc_heading",
        "Introduction ........ 3\nScope of all that follows here ...... 4\nother text, and what else there is to say of it": "toc_content",
        "v1.2 first\nRev. 3 second\n" + "x" * 80: "revision_history",
        "x" * 120: "diagram",
        "## Glossary\n" + long: "glossary",
        "# References\n" + long: "bibliography",
        long: "content",
    }
    for text, want in cases.items():
        assert one(spark, tx.page_class, text) == want, text[:40]


def test_orphan_captions(spark):
    assert one(spark, tx.drop_orphan_captions, "a\n\nFigure 3.1 x\n\nb") == "a\n\n\nb"
    assert one(spark, tx.drop_orphan_captions, "a\nFigure 3.1 x\n\nb") == "a\nFigure 3.1 x\n\nb"
    assert one(spark, tx.drop_orphan_captions, "Table 1") == ""


def test_quality_gate_bounds(spark):
    words = [f"w{i:02d}x" for i in range(40)]
    assert one(spark, tx.quality_reason, "x" * 159) == "few_tokens"
    assert one(spark, tx.quality_reason, "x" * 160) == "pass"
    assert one(spark, tx.quality_reason, " ".join((words[:3] * 4)[:10] * 5)) == "repetitive"
    assert one(spark, tx.quality_reason, " ".join(words)) == "pass"
    assert one(spark, tx.quality_reason, "# " + " ".join(words) + "\n" + "y" * 29) == "only_headings"


def test_chunk_classes(spark):
    def cls(text, page="content", first=False):
        df = spark.createDataFrame([(text, page)], "t string, p string")
        return df.select(tx.chunk_class(F.col("t"), idf.find_ids(F.col("t")), F.col("p"), first).alias("x")).first()["x"]

    assert cls("[SWS_ComM_00001]", "glossary") == "glossary"
    assert cls("[SWS_ComM_00001]") == "requirement_chunk"
    assert cls("[constr_0001]") == "requirement_chunk"
    assert cls("[constr_0001]", first=True) == "constraint_chunk"
    assert cls("dismay") == "requirement_chunk"
    assert cls("see figure 2") == "explanatory_chunk"
    assert cls("plain") == "general_chunk"


def test_ids_and_node_names(spark):
    assert one(spark, idf.find_ids, "[SWS_ComM_00001] [BSW_12345] [constr_0001] [SWS_ComM_00001] [E2E_Pro_0001] [x_1]") == ["SWS_ComM_00001", "BSW_12345", "constr_0001", "E2E_Pro_0001"]
    df = spark.createDataFrame([("Module", "Com Manager-1")], "l string, n string")
    assert df.select(tx.safe_node_id(F.col("l"), F.col("n")).alias("x")).first()["x"] == "module_com_manager1"
    assert one(spark, idf.module_name, "ComM") == "Communication Manager" and one(spark, idf.module_name, "Xy") == "Xy"


def test_harvest(spark):
    rows = [("a", 1, "content", "[SWS_ComM_00001] x [SRS_Can_00002] y [SWS_ComM_00001]"), ("a", 2, "content", "[constr_0001] z"), ("a", 3, "index", " ".join(f"[SWS_ComM_{i:05d}]" for i in range(3, 19)))]
    df = spark.createDataFrame(rows, "filename string, page_1idx int, content_type string, markdown string")
    found = harvest.mentions(df, "filename", "page_1idx", "markdown")
    known = harvest.inventory(found, spark.createDataFrame([("a", "Dcm")], "filename string, module string"), "filename", "page_1idx")
    got = {r["id"]: r for r in known.collect()}
    assert got["constr_0001"]["module"] == "Dcm" and got["SRS_Can_00002"]["module"] == "Can" and got["SWS_ComM_00001"]["id_type"] == "SWS"
    pairs = harvest.cooccurring(found, "filename", "page_1idx")
    assert [(r["from_id"], r["to_id"]) for r in pairs.collect()] == [("SWS_ComM_00001", "SRS_Can_00002")]
    assert harvest.cooccurring(found, "filename", "page_1idx", 16).count() == 1 + 120
    assert [r["cross_module"] for r in harvest.resolve_references(pairs, known).collect()] == [True]


def test_repeated_lines(spark):
    rows = [("f", i, ("HDR\n" if i < 2 else "") + ("X\nX\n" if i == 0 else "") + f"body {i}") for i in range(5)] + [("g", 9, "HDR\nonly")]
    df = spark.createDataFrame(rows, "file string, page int, text string")
    assert [(r["file"], r["line"]) for r in pages.repeated_lines(df, "file", "text").collect()] == [("f", "HDR")]
    out = {r["page"]: r["text"] for r in pages.strip_repeated_lines(df, "file", "text").collect()}
    assert out[0] == "X\nX\nbody 0" and out[9] == "HDR\nonly"


def test_greedy_duplicates(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "b", [1.0, 0.01]), (3, "b", [0.0, 1.0]), (4, "a", [1.0, 0.02]), (5, "c", [0.01, 1.0])]
    got = pages.greedy_duplicates(spark.createDataFrame(rows, "k int, f string, v array<double>"), "f", "k", "v").toPandas()
    assert dict(zip(got["k"], got["kept"], strict=True)) == {1: True, 2: False, 3: True, 4: True, 5: False}


def test_sections_links_and_tables(spark):
    md = "# A\nx\n## B\ny\n# C\nz"
    got = chunks.heading_sections(spark.createDataFrame([(1, md)], "k int, t string"), ["k"], "t").orderBy("section").collect()
    assert [(r["h1"], r["h2"], r["body"]) for r in got] == [("A", None, "# A\nx"), ("A", "B", "## B\ny"), ("C", None, "# C\nz")]
    table = "before\n| Parameter Name | Type | Multiplicity | Range | Description |\n|---|---|---|---|---|\n| Foo | INTEGER | 1 | 0..255 | a foo |\n\nafter"
    df = spark.createDataFrame([(1, table)], "k int, t string")
    rows = chunks.config_parameters(df, ["k"], "t").collect()
    assert [(r["name"], r["type"], r["multiplicity"], r["range"], r["description"]) for r in rows] == [("Foo", "INTEGER", "1", "0..255", "a foo")]
    assert chunks.without_tables(df, ["k"], "t").first()["t"] == "before\nafter"
    links = chunks.chunk_links(spark.createDataFrame([("f", 0, "c0"), ("f", 2, "c2"), ("g", 0, "d0")], "f string, i int, c string"), "f", ["i"], "c")
    assert {r["c"]: (r["prev_chunk_id"], r["next_chunk_id"]) for r in links.collect()} == {"c0": (None, "c2"), "c2": ("c0", None), "d0": (None, None)}


def test_splitter(spark):
    text = "\n\n".join(" ".join(f"w{i}_{j}" for j in range(60)) + "." for i in range(30))
    cut = chunks.split_text(text, 500, 80)
    assert all(0 < len(c) <= 500 for c in cut)
    words = [w for c in cut for w in c.split()]
    assert set(text.split()) == set(words)
    df = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "k int, t string")
    got = chunks.recursive_chunks(df, ["k"], "t", 500, 80, 100).toPandas()
    assert (got["k"] == 1).sum() == len(cut) and got[got["k"] == 2]["chunk"].tolist() == ["short"]


def test_noisy_json(spark):
    from weftline.sources.tables import extract_json, first_json_object

    assert one(spark, tx.parse_noisy_json, '```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(spark, tx.parse_noisy_json, 'so: {"a": [1]} end') == '{"a": [1]}'
    assert one(spark, tx.parse_noisy_json, "garbage") is None
    log = '12:00:00 INFO {not this}\n{"a": "}{", "b": {"c": 1}} rest'
    assert first_json_object(log) == '{"a": "}{", "b": {"c": 1}}'
    assert one(spark, extract_json, log) == '{"a": "}{", "b": {"c": 1}}'
    assert pd.isna(one(spark, extract_json, "none"))

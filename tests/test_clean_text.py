"""Hand-made edge values for cleaning, joins, text and ingestion."""

from pyspark.sql import functions as F

from meadow.operators import clean, joins, table, text
from meadow.sources import tables as src
from meadow.streaming.ingest import ingest_incremental


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_coordinates(spark):
    got = column(spark, ["12.5 N 45.2 W", "-12.5, 45.2", "40° 30' N 20° 15' W", "nowhere", None], clean.coordinate_pair(F.col("v")))
    assert [tuple(x) if x else None for x in got] == [(12.5, -45.2), (-12.5, 45.2), (40.5, -20.25), None, None]


def test_dates(spark):
    value, kind = clean.parse_date_precision(F.col("v"))
    vals = ["2020", "2020-05", "2020-05-17", "17 May", None, "2020-02-31"]
    assert column(spark, vals, value) == ["2020", "2020-05", "2020-05-17", None, None, None]
    assert column(spark, vals, kind) == ["year", "month", "day", "unknown", "unknown", "unknown"]


def test_nested(spark):
    assert column(spark, ["['a']", "{'value': 3}", "[]", "plain", "['a', 'b']"], clean.unpack_nested(F.col("v"))) == ["a", "3", None, "plain", "['a', 'b']"]


def test_accessions(spark):
    kind, conf = clean.classify_accession(F.col("v"))
    vals = ["SAMEA1234567", "SAMEA12", "srr123456.samn123456", "PRJEB1", "?"]
    assert column(spark, vals, kind) == ["SAMEA", "SAMEA", "COMPOUND", "PRJEB", None]
    assert column(spark, vals, conf) == [1.0, 0.7, 1.0, 1.0, 0.0]


def test_sample_ids(spark):
    df = spark.createDataFrame([(" A ", 2, "second"), ("a", 1, "first"), ("", 3, "x"), (None, 4, "y")], "sample_id string, ord int, v string")
    got = clean.clean_sample_ids(df, "ord").collect()
    assert [(r["#sampleid"], r["v"]) for r in got] == [("a", "first")]


def test_genus(spark):
    vals = ["k__B;p__P;g__Bacillus;s__", "k__B;p__Firm_x; ;uncultured", None]
    got = column(spark, vals, table.genus_of(F.col("v")))
    assert got == ["Bacillus", "pFirm x", "Unknown"]


def test_sections(spark):
    doc = "Intro\nMethods\nWe did it.\n\nResults\nIt worked."
    assert column(spark, [doc, "none"], text.section_between(F.col("v"))) == ["Methods\nWe did it.", text.NO_SECTION]


def test_page_text(spark):
    page = "<html><body><article>Hello<script>var x=1;</script> <a href='t.csv'>Table 1</a><a href='/x'>go away</a>&amp; skip to main content bye</article></body></html>"
    assert column(spark, [page], text.strip_boilerplate(F.col("v"))) == ["Hello [LINK: Table 1 - t.csv] & bye"]


def test_verify_dna(spark):
    docs = spark.createDataFrame([(1, "primer: ACGT-ACGT ACGTAC end")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "ACGTACGTACGTAC"), (1, "ACGT"), (1, "TTTTTTTTTTTT")], "doc_id int, item string")
    assert [r["item"] for r in text.verify_items(items, docs, "doc_id", "item", "text", True).collect()] == ["ACGTACGTACGTAC"]


def test_sync_ignores_case(spark):
    ab = spark.createDataFrame([("S1", "f", 1.0), ("s2", "f", 1.0)], "sample_id string, feature_id string, count double")
    meta = spark.createDataFrame([(" s1",), ("S3",)], "sample_id string")
    a, m = joins.sync_samples(ab, meta)
    assert a.count() == 1 and m.count() == 1


def test_merge_sources_prefers_first_unless_blank(spark):
    a = spark.createDataFrame([(1, " ", "x")], "id int, t string, u string")
    b = spark.createDataFrame([(1, "b", None), (2, "c", "y")], "id int, t string, u string")
    got = {r["id"]: (r["t"], r["u"], r["sources"]) for r in joins.merge_sources(a, b, "id").collect()}
    assert got == {1: ("b", "x", "ENA,SRA"), 2: ("c", "y", "SRA")}


def test_publications(spark):
    rows = [(1, "d1", "T", 2000), (2, "d1", "T", 2000), (3, "d1", "t ", 2000), (4, None, "U", None), (5, "d2", "T", 2000)]
    df = spark.createDataFrame(rows, "o int, doi string, title string, year int")
    assert sorted(r["o"] for r in joins.dedup_publications(df, "o").collect()) == [1, 2, 5]


def test_stream_equals_batch_and_skips_seen_files(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    a = spark.createDataFrame([(1, "f", 1.0), (2, "f", 2.0)], "sample_id long, feature_id string, count double")
    b = spark.createDataFrame([(1, "f", 5.0)], a.schema)
    a.coalesce(1).write.mode("append").parquet(source)
    first = ingest_incremental(spark, source, a.schema, out, state)
    assert {r["sample_id"]: r["count"] for r in first.collect()} == {1: 1.0, 2: 2.0}
    b.coalesce(1).write.mode("append").parquet(source)
    second = ingest_incremental(spark, source, a.schema, out, state)
    assert {r["sample_id"]: r["count"] for r in second.collect()} == {1: 6.0, 2: 2.0}
    batch = src.merge_tables(a, b)
    assert {r["sample_id"]: r["count"] for r in batch.collect()} == {1: 6.0, 2: 2.0}


def test_taxonomy_edges(spark):
    ab = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "sample_id long, feature_id string, count double")
    fm = spark.createDataFrame([("a", " nan "), ("b", None)], "feature_id string, genus string")
    assert [(r["feature_id"], r["count"]) for r in table.aggregate_by_rank(ab, fm, "genus").collect()] == [("Unassigned", 3.0)]

"""Operators on small frames of the budget schema's shape."""

import csv
import hashlib
import io
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arqueo import contracts
from arqueo.functions import exprs
from arqueo.operators import audit, consolidate, duplicates, model, profile, quality, reconcile, relationships
from arqueo.plans import marts
from arqueo.sources import config, files, landing

MONTHS = list(contracts.MONTHLY)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def texts(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def amounts(spark, year, months, annual):
    schema = ", ".join(["ano_eje int", *(f"{m} decimal(24,2)" for m in MONTHS), "monto_devengado_anual decimal(24,2)"])
    from decimal import Decimal

    d = lambda v: None if v is None else Decimal(v)
    return spark.createDataFrame([(year, *map(d, months), d(annual))], schema)


def test_contract_sizes():
    assert len(contracts.staging_schema()) == 73 and len(contracts.MEASURES) == 18
    assert len(contracts.MAXIMAL_KEY) == 30 and len(contracts.BUSINESS_KEY) == 24 and len(contracts.NAMES) == 25
    assert [len(d.key) for d in contracts.DIMENSIONS] == [1, 2, 9, 3, 3, 8, 3, 1]


def test_consolidation_of_split_measures(spark):
    rows = [("2026", "1", "a", " name ", "60", "80"), ("2026", "1", "a", "name", "40", ""), ("2026", "1", "b", "other", "1.5", "2")]
    df = texts(spark, ["y", "unit", "target", "label", "pim", "cert"], rows)
    grain = consolidate.Grain(("y", "unit", "target"), ("pim", "cert"))
    out = {r.target: r for r in consolidate.run(df, grain).collect()}
    assert (str(out["a"].pim), str(out["a"].cert), out["a"].label, out["a"].rows_merged) == ("100.00", "80.00", "name", 2)
    report = one(consolidate.reduction_report(consolidate.normalise(df, grain), grain))
    assert (report.rows_before, report.unique_rows, report.rows_after, report.rows_consolidated) == (3, 3, 2, 1)


def test_consolidation_refuses(spark):
    grain = consolidate.Grain(("k",), ("pim",))
    with pytest.raises(ValueError, match="no amounts"):
        consolidate.run(texts(spark, ["k", "pim"], [("a", "x1")]), grain)
    with pytest.raises(ValueError, match="differ"):
        consolidate.run(texts(spark, ["k", "d", "pim"], [("a", "u", "1"), ("a", None, "2")]), grain)
    with pytest.raises(ValueError, match="totals"):
        consolidate.run(texts(spark, ["k", "d", "pim"], [("a", "u", "1"), ("a", "u", "1")]), grain)
    assert consolidate.run(texts(spark, ["k", "d", "pim"], [("a", "u", "0"), ("a", "u", "0")]), grain).count() == 1
    with pytest.raises(ValueError, match="missing"):
        consolidate.run(texts(spark, ["k"], [("a",)]), grain)


def test_quality_controls(spark):
    good = amounts(spark, 2026, ["1"] * 12, "12").unionByName(amounts(spark, 2026, ["0"] * 12, "0"))
    assert one(quality.annual_reconciliation(good, MONTHS, "monto_devengado_anual")).status == "passed"
    assert one(quality.year_control(good, "ano_eje", 2026)).status == "passed"
    bad = amounts(spark, 2025, ["1"] * 12, "20")
    assert one(quality.annual_reconciliation(bad, MONTHS, "monto_devengado_anual")).mismatches == 1
    assert one(quality.year_control(bad, "ano_eje", 2026)).mismatches == 1
    hole = one(quality.annual_reconciliation(amounts(spark, 2026, ["1"] * 11 + [None], "12"), MONTHS, "monto_devengado_anual"))
    assert (hole.status, hole.not_evaluated) == ("warning", 1)
    minus = amounts(spark, 2026, ["-1", "1"] + ["0"] * 10, "0")
    assert {r.column_name: r.negatives for r in quality.negative_amounts(minus, MONTHS).collect() if r.negatives} == {MONTHS[0]: 1}
    with pytest.raises(ValueError):
        quality.annual_reconciliation(good, MONTHS[:3], "monto_devengado_anual")


def test_structural_and_unexpected_blanks(spark):
    columns = ["nivel_gobierno_nombre", "sector", "finalidad", "meta_nombre", "departamento_meta", "departamento_meta_nombre"]
    df = texts(spark, columns, [("GOBIERNOS LOCALES", " ", "99999", " ", "0", " "), ("NACIONAL", None, "1", " ", "5", "x")])
    got = {r.column_name: (r.structural, r.unexpected, r.status) for r in quality.blank_counts(df, columns).collect()}
    assert got["sector"] == (1, 0, "informational") and got["meta_nombre"] == (1, 1, "warning")
    assert got["departamento_meta_nombre"] == (1, 0, "informational") and got["finalidad"] == (0, 0, "passed")


def test_coverage_and_last_month(spark):
    df = spark.createDataFrame([(None, 1, 0), (2, 0, 3), (0, 0, 0)], "m1 int, m2 int, m3 int")
    cover = profile.monthly_coverage(df, ["m1", "m2", "m3"])
    assert [(r.month, r.non_null, r.nulls, r.non_zero) for r in cover.orderBy("month_number").collect()][0] == ("enero", 2, 1, 1)
    last = one(profile.last_populated_month(cover))
    assert (last.month, last.month_number, last.populated_months) == ("marzo", 3, 3)
    none = one(profile.last_populated_month(profile.monthly_coverage(df.where("false"), ["m1", "m2"])))
    assert none.month is None and none.populated_months == 0


def test_duplicates_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "a"), (3, "c"), (2, "b")], "id int, name string")
    got = one(duplicates.duplicate_summary(df))
    assert (got.row_count, got.unique_count, got.group_count, got.extra_rows, got.rows_in_groups, got.max_occurrences, got.status) == (5, 3, 2, 2, 4, 2, "warning")
    clean = one(duplicates.duplicate_summary(df.dropDuplicates()))
    assert (clean.extra_rows, clean.max_occurrences, clean.status) == (0, 1, "passed")
    keys = spark.createDataFrame([("1", "x", "p"), ("1", "x", "q"), ("2", None, "p")], "a string, b string, c string").withColumn("n", F.monotonically_increasing_id())
    by = {r.key_name: r for r in duplicates.key_uniqueness(keys, {"abc": ["a", "b", "c"], "ab": ["a", "b"]}).collect()}
    assert (by["abc"].unique_count, by["abc"].max_occurrences, by["ab"].group_count, by["ab"].extra_rows) == (3, 0, 1, 1)
    assert duplicates.collision_samples(keys, ["a", "b"], ["c"]).count() == 2
    assert duplicates.collision_samples(keys, ["a", "b"], ["c"], groups=0).count() == 0
    with pytest.raises(ValueError):
        duplicates.key_uniqueness(keys, {"x": ["a", "zz"]})


def test_row_digest(spark):
    def digest(values):
        h = hashlib.sha256()
        for v in values:
            b = ("<NULL>" if v is None else str(v)).encode()
            h.update(len(b).to_bytes(8, "big") + b)
        return h.hexdigest()

    rows = [(1, "é", None), (12, "", "x")]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    assert [r[0] for r in df.select(exprs.row_digest(["a", "b", "c"])).collect()] == [digest(r) for r in rows]


@pytest.mark.parametrize(
    "text,cents,extra,rounded",
    [("123", 12300, False, False), ("1.2", 120, False, False), ("1.2300", 123, True, False), ("", 0, False, False), ("1.234", 123, True, True),
     ("1.235", 124, True, True), ("-1.235", -124, True, True), ("0.30000000000000004", 30, True, True), ("abc", None, False, False), ("1e2", 10000, False, False),
     ("1.0049999999999999999", 100, True, True), ("1.5e-3", 0, True, True), ("1234e-3", 123, True, True), ("12.5e+1", 12500, False, False),
     ("1.2300e0", 123, True, False), ("-0.005", -1, True, True), (".5", 50, False, False), ("7.", 700, False, False), ("1e-40", 0, True, True),
     ("123456789012345678901234.565", 12345678901234567890123457, True, True), (None, 0, False, False), (" 1.20 ", 120, False, False), ("NaN", None, False, False)],
)
def test_cents(spark, text, cents, extra, rounded):
    r = one(texts(spark, ["t"], [(text,)]).select(exprs.cents("t").alias("c"), exprs.has_extra_digits("t").alias("e"), exprs.requires_rounding("t").alias("r")))
    assert (None if r.c is None else int(r.c), r.e, r.r) == (cents, extra, rounded)


def test_audit(spark):
    df = texts(spark, ["pia", "pim"], [("1.005", "0.1"), ("2.225", "0.20")])
    got = {r.column_name: (r.total, r.extra_digits, r.rounded) for r in audit.audit(df, ["pia", "pim"]).collect()}
    assert got == {"pia": ("3.24", 2, 2), "pim": ("0.30", 0, 0)}


def test_relationships_count_nulls(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 2, 5), (2, None, None)], "k int, a int, y int")
    got = one(relationships.relationship(df, "r", ["k"], ["a"]))
    assert (got.natural_keys, got.variants, got.conflicting_keys, got.additional_variants) == (2, 3, 1, 1)
    assert one(relationships.attribute_history(df, ["k"], "y", ["a"])).max_versions == 2


def test_large_numbering_equals_small(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k"), F.lit("x").alias("a"))
    a = {tuple(r) for r in model.number_small(df, ("k",), "n").collect()}
    assert a == {tuple(r) for r in model.number_large(df, ("k",), "n").collect()}


def test_star_and_checks(spark):
    dims = (contracts.Dimension("time", ("y",)), contracts.Dimension("place", ("c",), ("name",), labels={"label": ("name", "NONE")}))
    df = spark.createDataFrame([(1, "a", None, 5), (1, "b", "B", 6), (2, "b", "B", 7)], "y int, c string, name string, m decimal(24,2)".replace("decimal(24,2)", "int")).withColumn("m", F.col("m").cast("decimal(24,2)"))
    tables = {d.name: model.build_dimension(df, d) for d in dims}
    assert {r.c: r.label for r in tables["place"].collect()} == {"a": "NONE", "b": "B"}
    fact = model.load_fact(df, tables, dims, ["m"])
    assert fact.count() == 3
    holed = {**tables, "place": tables["place"].where("c <> 'a'")}
    assert {r.y: r.missing_place for r in model.coverage(df, holed, dims, "y").collect()} == {1: 1, 2: 0}
    compared = reconcile.compare_totals(df, df.where("y = 1"), "y", ["m"])
    assert {r.y: r.exact_match for r in compared.collect()} == {1: True, 2: False}
    with pytest.raises(ValueError):
        reconcile.require_exact(compared)
    with pytest.raises(ValueError, match="place"):
        model.require_empty({"place": df, "none": df.limit(0)})
    bad = model.foreign_keys(fact, {"f": (tables["place"].where("c = 'a'"), "place_key", "place_key")})
    assert one(bad).orphans == 2


def test_ratio_of_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(exprs.safe_ratio("a", "b")).collect()] == [0.0, 0.0, 0.25]
    assert marts.sliced(df, a=1, b=None).count() == 3


def test_config():
    raw = {"project": "p", "sources": [{"source_id": "d", "resource_type": "dictionary"}, {"source_id": "y", "reference_year": 2026, "mutable": True}]}
    sources = config.parse_config(raw)
    assert [s.source_id for s in config.select_sources(sources, everything=True)] == ["d", "y"]
    assert config.select_sources(sources, default="d")[0].resource_type == "dictionary"
    with pytest.raises(ValueError, match="known: d, y"):
        config.select_sources(sources, "zz")
    for wrong in ([], {"project": 1}, {"project": 1, "sources": []}):
        with pytest.raises(ValueError):
            config.parse_config(wrong)


def test_landing(spark):
    rows = [(b"a,b\n1,2", None, "csv"), (b"", None, "csv"), (b"a,b", 9, "csv"), (b"  <!DOCTYPE HTML><p>,", None, "csv"), (b"plain", None, "csv"), (b"plain", 5, "pdf")]
    df = spark.createDataFrame(rows, "c binary, size int, f string")
    assert [r[0] for r in df.select(landing.payload_problem(F.col("c"), F.col("size"), F.col("f"))).collect()] == [None, "empty", "incomplete", "html", "no_delimiter", None]
    manifests = spark.createDataFrame([("a", "success", 3, "h", "2026-01-01"), ("a", "updated", 4, "g", "2026-02-01")], "source_id string, status string, file_size_bytes int, sha256_hash string, recorded_at string")
    found = spark.createDataFrame([("a", 4, "other")], "source_id string, length int, sha256 string")
    assert one(landing.verify(manifests, found)).reason == "hash"
    quick = one(landing.verify(manifests, found, check_hash=False))
    assert quick.hash_matches is None and quick.valid
    assert one(landing.verify(manifests, found.limit(0))).reason == "missing_file"


def test_fetch(tmp_path):
    source, target = tmp_path / "s.csv", tmp_path / "t.csv"
    source.write_bytes(b"a,b\n")
    got = landing.fetch(source.as_uri(), lambda: target.open("wb"))
    assert (got.size, got.expected, got.head, got.sha256) == (4, 4, b"a,b\n", hashlib.sha256(b"a,b\n").hexdigest())
    with pytest.raises(OSError):
        landing.fetch((tmp_path / "none").as_uri(), lambda: target.open("wb"), tries=2, pause=0)


def test_short_body_and_retries(spark, tmp_path):
    """A server that ends a body early, one that fails twice, one that answers with an error."""
    import http.server
    import threading

    from arqueo.sources.config import SourceSpec

    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            if self.path == "/gone" or (self.path == "/busy" and asked.count("/busy") < 3):
                return self.send_error(404 if self.path == "/gone" else 503)
            body = b"x,y\n" * 1000
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body[:1500] if self.path == "/short" else body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        sources = [SourceSpec(i, download_url=f"http://127.0.0.1:{server.server_port}/{i}", mutable=True) for i in ("short", "busy", "gone", "whole")]
        rows = {r.source_id: r for r in landing.land(spark, sources, tmp_path / "in", tries=3, pause=0.01).collect()}
    finally:
        server.shutdown()
    assert (rows["short"].status, rows["short"].reason, rows["short"].expected_size_bytes) == ("failed", "incomplete", 4000)
    assert rows["busy"].status == "success" and asked.count("/busy") == 3
    assert rows["gone"].status == "failed" and asked.count("/gone") == 1
    assert (rows["whole"].status, rows["whole"].file_size_bytes) == ("success", 4000)
    assert sorted(x.name for x in (tmp_path / "in").iterdir()) == ["busy.csv", "whole.csv"]


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿ID,NAME\n007,\"x, y\"\n\n8\n".encode())
    df = files.read_text_csv(spark, str(path), encoding="utf-8-sig")
    assert files.header(spark, str(path)) == ["ID", "NAME"]
    rows = {r.ID: (r.NAME, r[files.CORRUPT] is not None) for r in df.cache().collect()}
    assert rows["007"] == ("x, y", False) and rows["8"][1]
    files.write_csv(spark.createDataFrame([("1", None)], "a string, b string"), str(tmp_path / "out"))
    assert "1," in "".join(x.read_text() for x in (tmp_path / "out").glob("part-*"))
    assert files.dictionary_problems(df.select("ID"), ["X"]) == ["header"]
    assert files.dictionary_problems(spark.createDataFrame([("a",), (" a",)], "v string"), ["v"]) == ["repeated a"]


def test_stream_intake(spark, tmp_path):
    from arqueo.streaming import intake

    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    spark.range(5).write.parquet(src)
    schema = spark.read.parquet(src).schema
    intake.land_available(intake.file_stream(spark, src, schema), out, mark)
    spark.range(5, 8).write.mode("append").parquet(src)
    intake.land_available(intake.file_stream(spark, src, schema), out, mark)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(8))


def test_windowed_stream(spark, tmp_path):
    from arqueo.streaming import intake

    src = str(tmp_path / "ev")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(src)
    events = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    query = intake.windowed_totals(intake.unique_events(intake.with_delay(events), ["event_id"])).writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("w").count() >= 0


def test_cli(spark, tmp_path, capsys):
    from arqueo import cli

    path = tmp_path / "in.csv"
    path.write_text("KEY,NAME,MONTO_PIM\n1,a,2\n1,a ,3\n2,b,1\n")
    assert cli.main(["consolidate", str(path), "--key", "key", "--out", str(tmp_path / "out")], spark) == 0
    assert {r.key: str(r.monto_pim) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"1": "5.00", "2": "1.00"}
    for action in ("profile", "quality", "duplicates", "audit"):
        assert cli.main([action, str(path), "--report", str(tmp_path / action)], spark) == 0
        assert spark.read.json(str(tmp_path / action)).count() > 0
    assert cli.main(["grain", str(path), "--key", "zz"], spark) == 1
    assert "missing" in capsys.readouterr().err


def test_catalog(spark):
    from arqueo.sources import catalog

    catalog.create_layer(spark, "layer_x", "it's a layer")
    catalog.save_layer_table(spark.range(7), "layer_x.t")
    catalog.analyze(spark, "layer_x.t")
    assert one(catalog.table_sizes(spark, ["layer_x.t"])).row_count == 7
    spark.sql("DROP DATABASE layer_x CASCADE")


def test_encoding_and_splits(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("ID,PAÍS\n1,España\n".encode("latin-1"))
    assert one(files.read_text_csv(spark, str(path), encoding="latin-1", keep_malformed=False)) == ("1", "España")
    assert one(files.numbered_records(spark, str(path), "latin-1"))["PAÍS"] == "España"
    big = tmp_path / "big.csv"
    big.write_text("ID,NAME\n" + "".join(f"{i},name {i}\n" for i in range(60000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 17))
    try:
        assert files.read_text_csv(spark, str(big)).rdd.getNumPartitions() > 3
        numbered = files.numbered_records(spark, str(big))
        assert numbered.where(F.col("ID").cast("bigint") + 2 != F.col(files.ROW_NUMBER)).isEmpty()
        assert numbered.count() == 60000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    folded = tmp_path / "folded.csv"
    folded.write_text('ID,NAME\n1,"two\nlines"\n')
    assert one(files.read_text_csv(spark, str(folded), keep_malformed=False, multi_line=True)).NAME == "two\nlines"


def test_numbered_records(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('ID,NAME\n1,a\n\n2,"b, c"\n3\n1,a\n')
    rows = files.numbered_records(spark, str(path)).orderBy(files.ROW_NUMBER).collect()
    assert [(r[files.ROW_NUMBER], r["_blank"], r.ID, r.NAME, r[files.CORRUPT] is not None) for r in rows] == [
        (2, False, "1", "a", False), (3, True, None, None, False), (4, False, "2", "b, c", False), (5, False, "3", None, True), (6, False, "1", "a", False)
    ]
    assert tuple(one(files.record_counts(files.numbered_records(spark, str(path))))) == (4, 1, 1)
    found = duplicates.duplicate_rows(files.numbered_records(spark, str(path)).where("not _blank"), ["ID", "NAME"], files.ROW_NUMBER).collect()
    assert sorted(r[files.ROW_NUMBER] for r in found) == [2, 6] and len({r._row_hash for r in found}) == 1


def test_landing_as_one_operation(spark, tmp_path):
    from arqueo.sources.config import SourceSpec

    remote, local, log = tmp_path / "remote", tmp_path / "local", str(tmp_path / "log")
    remote.mkdir()
    (remote / "a.csv").write_bytes(b"x,y\n1,2\n")
    (remote / "b.csv").write_bytes(b"<!DOCTYPE html><p>error</p>")
    spec = lambda i, mutable=False: SourceSpec(i, download_url=(remote / f"{i}.csv").as_uri(), mutable=mutable)
    sources = [spec("a", True), spec("b"), spec("c")]

    def land(force=False):
        out = landing.land(spark, sources, local, force, tries=1, pause=0)
        landing.append_manifest(out, log)
        return {r.source_id: (r.status, r.reason) for r in out.collect()}

    first = land()
    assert first["a"] == ("success", None) and first["b"] == ("failed", "html") and first["c"][0] == "failed"
    assert sorted(x.name for x in local.iterdir()) == ["a.csv"]
    assert land()["a"][0] == "unchanged" and land(force=True)["a"][0] == "refreshed"
    (remote / "a.csv").write_bytes(b"x,y\n1,3\n")
    assert land()["a"][0] == "updated"
    sources[0] = spec("a")
    assert land()["a"][0] == "skipped_existing"
    manifests = landing.read_manifests(spark, log)
    checked = {r.source_id: (r.valid, r.reason) for r in landing.verify(manifests, landing.landed_files(spark, manifests)).collect()}
    assert checked["a"] == (True, None) and checked["b"] == (False, "status")
    (local / "a.csv").write_bytes(b"x,y\n1,4\n")
    checked = {r.source_id: r.reason for r in landing.verify(manifests, landing.landed_files(spark, manifests)).collect()}
    assert checked["a"] == "hash"
    (local / "a.csv").unlink()
    assert {r.source_id: r.reason for r in landing.verify(manifests, landing.landed_files(spark, manifests)).collect()}["a"] == "missing_file"


def test_assertions_that_stop_a_load(spark):
    n = lambda rows: spark.createDataFrame(rows, "year int, n bigint")
    model.require_counts(n([(1, 2)]), n([(1, 2)]), "year")
    with pytest.raises(ValueError, match="2: None instead of 1"):
        model.require_counts(n([(1, 2)]), n([(1, 2), (2, 1)]), "year")
    model.require_dimension_counts({"d": spark.range(3)}, {"d": 3})
    with pytest.raises(ValueError, match="d: 3 instead of 4; *e|e is missing; d: 3 instead of 4"):
        model.require_dimension_counts({"d": spark.range(3)}, {"d": 4, "e": 1})
    covered = spark.createDataFrame([(1, 2, 0), (2, 3, 1)], "year int, row_count bigint, rows_missing_any bigint")
    model.require_coverage(covered.where("year = 1"), n([(1, 2)]), "year")
    with pytest.raises(ValueError, match="2: 1 rows"):
        model.require_coverage(covered, n([(1, 2), (2, 3)]), "year")
    keys = spark.createDataFrame([("a", 0, True), ("b", 2, False)], "constraint_name string, orphans bigint, valid boolean")
    model.require_foreign_keys(keys.where("valid"), 1)
    with pytest.raises(ValueError, match="2 constraints instead of 8; b: 2 orphans"):
        model.require_foreign_keys(keys, 8)


def test_candidate_keys_share_groups(spark):
    rows = [("1", "x", "p"), ("1", "x", "q"), ("2", "x", None), ("2", "x", None)]
    df = texts(spark, ["A", "B", "C"], rows)
    got = {r.key_name: (r.unique_count, r.group_count, r.extra_rows, r.max_occurrences) for r in duplicates.key_uniqueness(df, {"ab": ["A", "B"], "abc": ["A", "B", "C"], "c": ["C"]}).collect()}
    assert got == {"ab": (2, 2, 2, 2), "abc": (3, 1, 1, 2), "c": (3, 1, 1, 2)}
    assert duplicates.sample_key({"maximal": [], "business": []}) == "business" and duplicates.sample_key({"z": [], "y": []}) == "z"
    with pytest.raises(ValueError, match="unknown key"):
        duplicates.sample_key({"a": []}, "b")


def test_dictionary_review_and_report(spark):
    known, present = texts(spark, ["column_name"], [("a",), ("b",), ("b",)]), texts(spark, ["column_name"], [("b",), ("c",)])
    assert tuple(one(profile.dictionary_review(known, present, "h", "h"))) == (1, 1, 1, True, False)
    assert one(profile.dictionary_review(known, known, "h", "g"))[3:] == (False, True)
    lines = [r.line for r in files.markdown_report("T", {"One": texts(spark, ["x"], [("a|b",)]), "None": known.limit(0)}).orderBy("position").collect()]
    assert lines == ["# T", "", "## One", "", "| x |", "| --- |", "| a\\|b |", "## None", "", "No rows.", ""]
    variables = files.dictionary_variables(texts(spark, ["V"], [(" a",), ("a",), ("",), (None,)]), "V")
    assert [r.variable for r in variables.collect()] == ["a"]


def test_cli_quality_and_samples(spark, tmp_path):
    from arqueo import cli

    months = [f"MONTO_DEVENGADO_{m.upper()}" for m in contracts.MONTHS]
    path = tmp_path / "q.csv"
    path.write_text(",".join(["ANO_EJE", "META_NOMBRE", *months, "MONTO_DEVENGADO_ANUAL"]) + "\n" + ",".join(["2025", "  "] + ["1"] * 12 + ["20"]) + "\n")
    assert cli.main(["quality", str(path), "--year", "2026", "--report", str(tmp_path / "r")], spark) == 0
    got = {(r.control, r["item"], r.metric): (r.value, r.status) for r in spark.read.json(str(tmp_path / "r")).collect()}
    assert got["year", None, "mismatches"] == ("1", "failed") and got["reconciliation", None, "mismatches"] == ("1", "failed")
    assert cli.main(["profile", str(path), "--report", str(tmp_path / "classes")], spark) == 0
    kinds = {r.column_name: (r["class"], r["month_number"]) for r in spark.read.json(str(tmp_path / "classes")).select("column_name", "class", "month_number").collect()}
    assert kinds["MONTO_DEVENGADO_MARZO"] == ("monthly", 3) and kinds["MONTO_DEVENGADO_ANUAL"] == ("annual", None) and kinds["ANO_EJE"] == (None, None)
    assert got["summary", None, "critical_failed"][0] == "2" and got["blanks", "meta_nombre", "unexpected"] == ("1", "warning")
    path.write_text("KEY,NAME,MONTO_PIM\n2,b,1\n1,a,2\n\n2,b,1\n1,a ,3\n")
    assert cli.main(["duplicates", str(path), "--out", str(tmp_path / "d"), "--report", str(tmp_path / "dr")], spark) == 0
    assert one(spark.read.json(str(tmp_path / "dr"))).blank_records == 1
    assert spark.read.csv(str(tmp_path / "d"), header=True).count() == 2
    assert cli.main(["consolidate", str(path), "--key", "key", "--tolerance", "1", "--csv", str(tmp_path / "c")], spark) == 0
    assert [r.key for r in spark.read.csv(str(tmp_path / "c"), header=True).collect()] == ["2", "1"]
    words = tmp_path / "dict.csv"
    words.write_text("VARIABLE\nKEY\nother\n")
    assert cli.main(["profile", str(path), "--dictionary", str(words), "--report", str(tmp_path / "p")], spark) == 0
    status = {r.column_name: r.status for r in spark.read.json(str(tmp_path / "p")).collect()}
    assert status == {"key": "documented", "name": "undocumented", "monto_pim": "undocumented", "other": "dictionary_only"}
    assert cli.main(["dictionary", str(path), "--dictionary", str(words), "--out", str(tmp_path / "md"), "--report", str(tmp_path / "x")], spark) == 0
    assert not one(spark.read.json(str(tmp_path / "x"))).exact_schema_match
    assert cli.main(["audit", str(path), "--measures", "18"], spark) == 1


def test_entry_without_the_libraries_of_the_subpackage(tmp_path):
    """The core queries load where a library that only arqueo.llm needs is missing."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    code = "import sys; sys.modules['zstandard'] = None; sys.modules['tiktoken'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(x.startswith('op1_') for x in q))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 70 and out[1] == "False"


def test_empty_selection_has_an_answer(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert [tuple(r) for r in marts.or_message(df, "no data").collect()] == [(1, "a", None)]
    assert [tuple(r) for r in marts.or_message(df.where("x > 1"), "no data").collect()] == [(None, None, "no data")]


def test_approximate_statistics(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    exact = {r.column_name: r for r in profile.column_statistics(lines, columns).collect()}
    for r in profile.column_statistics(lines, columns, approximate=True).collect():
        want = exact[r.column_name]
        assert abs(r.distinct_values - want.distinct_values) <= 0.15 * want.distinct_values
        assert (r.null_percent, r.average_bytes) == (want.null_percent, want.average_bytes)


@pytest.mark.parametrize(
    "text,cents,amount",
    [("1.5e20", 15 * 10**21, "150000000000000000000.00"), ("2e25", 2 * 10**27, None), ("1e30", 10**32, None), ("-1e22", -(10**24), None),
     ("123456789012345678901234567890.125", 12345678901234567890123456789013, None), ("１２", None, None), ("1e40", None, None), ("1_000", None, None),
     ("9999999999999999999999.994", 10**24 - 1, "9999999999999999999999.99"), ("9999999999999999999999.995", 10**24, None), ("　", 0, "0.00"), ("1e0002", 10000, "100.00"),
     ("1" * 400 + "x", None, None), ("1e-999", 0, "0.00")],
)
def test_no_amount_vanishes(spark, text, cents, amount):
    df = texts(spark, ["k", "pim"], [("a", text)])
    r = one(df.select(exprs.cents("pim").alias("c"), exprs.parse_amount("pim").alias("p"), exprs.is_bad_amount("pim").alias("bad")))
    assert (None if r.c is None else int(r.c), None if r.p is None else str(r.p), r.bad) == (cents, amount, amount is None)
    a = one(audit.audit(df, ["pim"]))
    assert a.invalid == (cents is None) and a.total == str(exprs_total(cents))
    if amount is None:
        with pytest.raises(ValueError, match="no amounts in: pim"):
            consolidate.run(df, consolidate.Grain(("k",), ("pim",)))


def exprs_total(cents):
    from decimal import Context, Decimal

    return Decimal(cents or 0).scaleb(-2, Context(prec=60)).quantize(Decimal("0.01"), context=Context(prec=60))


def test_eighteen_text_measures_compile(spark, capfd):
    """Code for the parsing of all measures is compiled: the JVM's limit of 64 KB a method isn't met."""
    measures = list(contracts.MEASURES)
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), *[F.concat((F.col("id") * (i + 1)).cast("string"), F.lit(".125")).alias(m) for i, m in enumerate(measures)])
    grain = consolidate.Grain(("k",), tuple(measures))
    loaded = consolidate.load(df, grain)
    assert loaded.report().first() == (3000, 3000, 3000, 0, 0, 0)
    got = {r.column_name: r for r in audit.audit(df, measures, 18).collect()}
    n = 3000 * 2999 // 2
    assert [got[m].total for m in measures] == [f"{n * (i + 1) + 3000 * 13 // 100}.{3000 * 13 % 100:02d}" for i, m in enumerate(measures)]
    assert all(r.rounded == r.extra_digits == 3000 and r.invalid == 0 for r in got.values())
    assert "64 KB" not in "".join(capfd.readouterr())
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", loaded_code(spark, consolidate.normalise(df, grain)))]
    assert sizes and max(sizes) < 60_000


def loaded_code(spark, df):
    return spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())


def test_load_scans_once(spark, tmp_path):
    path = str(tmp_path / "in")
    texts(spark, ["k", "d", "pim"], [("a", "u", "1.50"), ("a", "u", "2"), ("b", None, "0"), ("b", None, "0")]).write.parquet(path)
    df, grain = spark.read.parquet(path), consolidate.Grain(("k",), ("pim",))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "load")
    try:
        loaded = consolidate.load(df.withColumn("no", F.monotonically_increasing_id()), grain, row_number="no")
        jobs = tracker.getJobIdsForGroup("load")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # A job for each exchange and one that writes; none reads the source again.
    assert len(jobs) <= 3
    assert loaded.report().first() == (4, 3, 2, 1, 1, 2)
    assert {r.k: (str(r.pim), r.rows_merged) for r in loaded.rows.collect()} == {"a": ("3.50", 2), "b": ("0.00", 1)}
    loaded.remove()


def test_records_over_splits(spark, tmp_path):
    """Quoted line breaks, in splits of any size: numbers and fields as Python's csv module has them."""
    rng = random.Random(7)

    def cell():
        kind = rng.random()
        if kind < 0.4:
            return '"' + "".join(rng.choice(["a", "\n", "\r\n", ",", '""', "é"]) for _ in range(rng.randint(0, 8))) + '"'
        return 'x"y' if kind < 0.5 else str(rng.randint(0, 9999))

    for eol in ("\n", "\r\n"):
        body = f"A,B,C{eol}" + "".join((eol if rng.random() < 0.05 else ",".join(cell() for _ in range(3)) + eol) for _ in range(400))
        path = tmp_path / f"r{len(eol)}.csv"
        path.write_bytes(body.encode())
        want = {i: [x or None for x in r] for i, r in enumerate(csv.reader(io.StringIO(body, newline="")), 1) if r and i > 1}
        for size in (1 << 20, 2000, 300):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            try:
                rows = files.numbered_records(spark, str(path)).where("not _blank").collect()
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            assert {r[files.ROW_NUMBER]: [r.A, r.B, r.C] for r in rows} == want
    empty = tmp_path / "empty.csv"
    empty.write_bytes(b"A,B\n")
    assert files.numbered_records(spark, str(empty)).count() == 0


def test_open_quote_is_an_error(spark, tmp_path):
    from arqueo.sources import records

    path = tmp_path / "open.csv"
    path.write_text('A,B\n1,"never closed\n' + "x,y\n" * (records.MAX_RECORD_LINES + 10))
    with pytest.raises(Exception, match="not closed"):
        records.record_texts(spark, str(path)).count()


def test_cli_keeps_records_with_line_breaks(spark, tmp_path):
    from arqueo import cli

    path = tmp_path / "m.csv"
    path.write_text('KEY,NAME,MONTO_PIM\n2,"two\nlines",1.5\n1,a,2\n2,"two\nlines",3\n')
    assert cli.main(["consolidate", str(path), "--key", "key", "--out", str(tmp_path / "o"), "--csv", str(tmp_path / "c"), "--report", str(tmp_path / "r")], spark) == 0
    assert {r.key: (r["name"], str(r.monto_pim)) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {"2": ("two\nlines", "4.50"), "1": ("a", "2.00")}
    out = "".join(x.read_text() for x in sorted((tmp_path / "c").glob("part-*")))
    assert [r[0] for r in csv.reader(io.StringIO(out)) if r and r[0] != "key"] == ["2", "1"]
    assert one(spark.read.json(str(tmp_path / "r"))).rows_before == 3
    assert cli.main(["consolidate", str(path), "--key", "key", "--multi-line", "--report", str(tmp_path / "r2")], spark) == 0
    assert one(spark.read.json(str(tmp_path / "r2"))).rows_after == 2
    path.write_text('KEY,NAME\n1,"x\ny"\n2,b\n1,"x\ny"\n')
    assert cli.main(["duplicates", str(path), "--multi-line", "--out", str(tmp_path / "d"), "--report", str(tmp_path / "dr")], spark) == 0
    assert spark.read.option("multiLine", True).csv(str(tmp_path / "d"), header=True).count() == 2
    assert cli.main(["grain", str(path), "--key", "key", "--multi-line", "--out", str(tmp_path / "g"), "--report", str(tmp_path / "gr")], spark) == 0
    assert one(spark.read.json(str(tmp_path / "gr"))).row_count == 3


def test_snapshots(spark, tmp_path):
    from arqueo.sources.snapshots import Snapshots

    def refuse(tables):
        if tables["table"].count() < 3:
            raise ValueError("too few")

    store = Snapshots(spark, f"file://{tmp_path}/t")
    with pytest.raises(ValueError, match="nothing"):
        store.read()
    assert store.publish(spark.range(5), refuse) == 1
    with pytest.raises(ValueError, match="too few"):
        store.publish(spark.range(2), refuse)
    assert store.versions() == [1] and len(list((tmp_path / "t" / "versions").iterdir())) == 1
    old = store.read()
    assert store.publish({"table": spark.range(9), "other": spark.range(1)}) == 2
    assert (old.count(), store.read().count(), store.read("other").count(), store.read(version=1).count()) == (5, 9, 1, 5)
    (tmp_path / "t" / "pointers" / "0000000003").write_bytes(b"")  # a publisher that is about to write
    assert store.current() == 2 and store.publish(spark.range(4)) == 4
    assert store.expire(1) == 2 and store.versions() == [4] and store.read().count() == 4
    with pytest.raises(ValueError, match="no version 1"):
        store.read(version=1)


def test_readers_find_a_version_while_others_publish(spark, tmp_path):
    """Two publishers and a reader at once: the reader always finds a whole version, and none is lost."""
    import threading

    from arqueo.sources.snapshots import Snapshots

    path = f"file://{tmp_path}/t"
    Snapshots(spark, path).publish(spark.range(10).withColumn("v", F.lit(0)))
    problems, done = [], threading.Event()

    def publish(v):
        try:
            for i in range(4):
                Snapshots(spark, path).publish(spark.range(10).withColumn("v", F.lit(v + i)))
        except Exception as e:
            problems.append(e)

    def read():
        while not done.is_set():
            try:
                rows = Snapshots(spark, path).read().collect()
                if len(rows) != 10 or len({r.v for r in rows}) != 1:
                    problems.append(rows)
            except Exception as e:
                problems.append(e)

    reader = threading.Thread(target=read)
    writers = [threading.Thread(target=publish, args=(v,)) for v in (10, 20)]
    for t in (reader, *writers):
        t.start()
    for t in writers:
        t.join()
    done.set()
    reader.join()
    assert not problems
    assert Snapshots(spark, path).versions() == list(range(1, 10))


def test_stream_upsert_equals_one_batch(spark, tmp_path):
    """Three files as three batches, one of them sent again, with a restart between, equal one consolidation."""
    from arqueo.sources.snapshots import Snapshots
    from arqueo.streaming import intake, upsert

    grain = consolidate.Grain(("k",), ("pim",))
    parts = [
        [("a", "u", "1.005"), ("b", None, "2"), ("b", None, "2")], [("a", "u", "1.005"), ("a", "u", "3"), ("c", "w", "")], [("b", None, "2"), (None, "x", "7"), ("c", "w", "-1")],
    ]
    src, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    schema = texts(spark, ["k", "d", "pim"], []).schema
    store = Snapshots(spark, f"file://{tmp_path}/out")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        upsert.upsert_available(intake.file_stream(spark, src, schema), store, grain, mark)
    upsert.merge(store, spark.createDataFrame(parts[2], schema), 2, grain)
    whole = consolidate.consolidate(consolidate.unique_rows(consolidate.normalise(spark.createDataFrame(sum(parts, []), schema), grain)), grain)
    assert sorted(map(tuple, store.read("keys").collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert len(store.versions()) == 2
    with pytest.raises(ValueError, match="no amounts"):
        upsert.merge(store, spark.createDataFrame([("z", "q", "1,5")], schema), 9, grain)
    assert store.read("progress").first().batch_id == 2


def exchanges(df):
    """The exchanges of a plan that are dealt by keys."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_checks_share_one_exchange(spark):
    """Nine dependencies and three keys that cross read the rows once and exchange them once."""
    rng = random.Random(3)
    rows = [tuple(rng.choice([None, "1", "2", "3", "4"]) for _ in range(6)) for _ in range(300)]
    df = texts(spark, list("abcdef"), rows)
    checks = {f"r{i}": (["a", "b", "c"][: i % 3 + 1], ["d", "e", "f"][: i // 3 + 1]) for i in range(9)}
    out = relationships.relationships(df, checks)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan ExistingRDD[a#") == 1
    got = {r.relationship: tuple(r)[1:] for r in out.collect()}
    for name, (key, attributes) in checks.items():
        at = {c: i for i, c in enumerate("abcdef")}
        variants = {(tuple(r[at[c]] for c in key), tuple(r[at[c]] for c in attributes)) for r in rows}
        n = Counter(k for k, _ in variants)
        assert got[name] == (len(n), len(variants), sum(v > 1 for v in n.values()), len(variants) - len(n), max(n.values()))
    assert {tuple(r)[1:] for r in relationships.relationships(df.limit(0), checks).collect()} == {(0, 0, 0, 0, 0)}
    keys = {"ab": ["a", "b"], "cd": ["c", "d"], "bd": ["b", "d"], "ba": ["b", "a"]}
    out = duplicates.key_uniqueness(df, keys)
    # One exchange of groups by key, one of their summaries, and that of the names.
    assert exchanges(out) <= 3
    for r in out.collect():
        n = Counter(tuple(x["abcdef".index(c)] for c in keys[r.key_name]) for x in rows)
        assert (r.row_count, r.unique_count, r.max_occurrences) == (300, len(n), max(n.values()))
    assert [r.row_count for r in duplicates.key_uniqueness(df.limit(0), keys).collect()] == [0] * 4


def test_cube_answers_from_the_smallest_level(spark, tmp_path):
    from arqueo.plans.cube import Cube

    df = spark.range(600).selectExpr("cast(id % 3 as int) y", "cast(id % 5 as int) m", "cast(id % 7 as int) s", "cast(id as decimal(24,2)) budget", "cast(1 as decimal(24,2)) accrued")
    df.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    cube = Cube.build(facts, {"fine": ("y", "m", "s"), "ym": ("y", "m"), "y": ("y",)}, ("budget", "accrued"), str(tmp_path / "cube"))
    assert cube.sizes == {"fine": 105, "ym": 15, "y": 3}
    assert (cube.level_for({"y"}), cube.level_for({"m"}), cube.level_for({"s", "y"})) == ("y", "ym", "fine")
    for by, filters in ((["y"], {}), (["y"], {"m": [1, 2]}), (["s"], {"y": 2, "m": None}), (["m", "y"], {})):
        out = cube.slice(by, **filters)
        assert not [x for x in out.inputFiles() if "/facts/" in x]
        want = marts.amounts_by(marts.sliced(facts, **filters), by, ("budget", "accrued"))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="no level"):
        cube.slice(["z"])
    cube.remove()


def test_sketches_merge(spark):
    from arqueo.operators import sketches

    df = spark.range(20000).selectExpr("cast(id % 4 as int) p", "id % 5000 as a", "cast(id % 100 as string) t", "case when id % 2 = 0 then cast(id as double) end as h", "cast(null as int) as z")
    parts = sketches.sketched(df, ["p"], ["a", "t", "h", "z"])
    assert parts.count() == 16
    got = {r.column_name: r for r in sketches.answers(sketches.merged(parts), (0.5,)).collect()}
    assert abs(got["a"].distinct_values - 5000) < 250 and abs(got["t"].distinct_values - 100) < 5 and got["z"].distinct_values == 0
    assert abs(got["a"].quantiles[0] - 2500) < 100 and got["t"].quantiles is None and got["z"].quantiles is None
    assert (got["h"].null_percent, got["z"].null_percent, got["a"].row_count) == (50.0, 100.0, 20000)
    assert sketches.merged(parts, ["p"]).count() == 16
    assert sketches.answers(sketches.merged(sketches.sketched(df.where("false"), ["p"], ["a"]))).count() == 0


def test_controls_observed_in_the_load(spark, tmp_path):
    """A consolidation with all controls reads its source once; the controls say what they say of a table."""
    months = list(contracts.MONTHLY)
    rows = [("2026", " ", "GOBIERNOS LOCALES", *["1.5"] * 12, "18"), ("2025", "x", None, *["2"] * 11, "", "-3"), ("2026", "z", "y", *["1"] * 12, "20")]
    names = ["ano_eje", "sector", "nivel_gobierno_nombre", *months, "monto_devengado_anual"]
    texts(spark, names, rows).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    measures = [*months, "monto_devengado_anual"]
    controls = quality.controls_of(names, measures, ("ano_eje", 2026), months, "monto_devengado_anual")
    loaded = consolidate.load(df, consolidate.Grain(("ano_eje", "sector"), tuple(measures)), controls=controls)
    for name, control in controls.items():
        assert sorted(map(tuple, loaded.controls[name].collect()), key=repr) == sorted(map(tuple, control.of(df).collect()), key=repr), name
    assert tuple(one(loaded.controls["year"])) == (0, 0, 1, "2025,2026", "failed")
    assert one(loaded.controls["reconciliation"])[:3] == (1, 1, 1)
    assert {r.column_name: r.structural for r in loaded.controls["blanks"].collect()}["sector"] == 1
    assert one(quality.quality_summary(*[loaded.controls[k] for k in ("year", "reconciliation", "nulls", "blanks", "amounts", "negatives")])).critical_failed == 2
    loaded.remove()
    plan = spark.read.parquet(str(tmp_path / "in"))
    watched, results = profile.observed(plan, controls)
    assert watched._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_old_shared_tables_are_swept(spark, tmp_path):
    from arqueo.sources import storage

    base = f"file://{tmp_path}/shared"
    assert storage.sweep_shared(spark, 0, base) == 0
    (tmp_path / "shared" / "other").mkdir(parents=True)
    for name in ("table-1", "arqueo-2"):
        spark.range(3).write.parquet(f"{base}/{name}")
    assert storage.sweep_shared(spark, 3600, base) == 0 and spark.read.parquet(f"{base}/table-1").count() == 3
    assert storage.sweep_shared(spark, -60, base) == 2
    assert [x.name for x in (tmp_path / "shared").iterdir()] == ["other"]


def test_large_dimensions_exchange_narrow_rows(spark):
    """Rows meet large dimensions with the small ones' numbers in one column, and without their texts."""
    dims = (contracts.Dimension("big", ("k", "j"), small=False), *(contracts.Dimension(f"d{i}", (f"t{i}",)) for i in range(9)))
    df = spark.range(600).select((F.col("id") % 37).alias("k"), (F.col("id") % 29).alias("j"), *[F.concat(F.lit("t"), F.col("id") % (i + 2)).alias(f"t{i}") for i in range(9)], F.col("id").alias("m"))
    tables = model.build_dimensions(df, dims)
    rows = df.collect()
    numbers = {d.name: {v: i for i, v in enumerate(sorted({tuple(r[c] for c in d.key) for r in rows}), 1)} for d in dims}
    want = {(*(numbers[d.name][tuple(r[c] for c in d.key)] for d in dims), r.m) for r in rows}
    assert {tuple(r) for r in model.load_fact(df, tables, dims, ["m"]).collect()} == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = model.load_fact(df, tables, dims, ["m"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (exchanged,) = re.findall(r"Exchange hashpartitioning\(k#\d+L, j#\d+L.*\n.*Project \[(.*m#.*)\]", plan)
    assert "_packed0" in exchanged and not re.search(r"\bt\d#|d\d_key#\d+[,\]]", re.sub(r"\(.*\) AS ", "", exchanged))
    # More bits than one column has; what no bit holds stays apart.
    tops = {f"n{i}": spark.createDataFrame([((1 << 30) + i,)], f"n{i} int") for i in range(5)}
    wide = spark.createDataFrame([tuple((1 << 30) + i for i in range(5))], ", ".join(f"n{i} int" for i in range(5)))
    packed, unpacked = model._packed(tops)
    assert len(packed) == 3 and tuple(one(wide.select(*packed).select(*[c.alias(n) for n, c in unpacked.items()]))) == tuple(one(wide))


def test_constraints_that_do_not_hold(spark):
    dims = (contracts.Dimension("d", ("k",)),)
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "c"), (3, None)], "d_key int, k string")
    fact = spark.createDataFrame([(1, 5), (1, 5), (4, 5), (4, 5), (None, 5)], "d_key int, m int")
    got = {r.kind: (r.table_name, r.column_count, r.row_count, r.violations) for r in model.constraint_catalog({"d": table}, dims, fact).collect()}
    assert got == {"primary": ("d", 2, 5, 2), "unique": ("d", 2, 5, 1), "not_null": ("d", 2, 5, 2), "foreign": ("fact", 2, 5, 2)}


def test_texts_of_measures_are_compiled_to_machine_code(spark):
    """The stage that makes and audits the texts stays small, and long rows are audited as wide ones are."""
    from arqueo.plans import queries

    made = queries._text_measures(spark, "/root/testdata/sf0.001")
    assert made.columns == ["column_name", "value"]
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", loaded_code(spark, made))]
    assert sizes and max(sizes) < 8000
    rows = [("1.005", "0.1"), ("2.2250", "1e-3"), ("7.001000", " "), ("3.120", "x"), ("12", ".0009"), ("5.", "1.10e1")]
    wide = texts(spark, ["pia", "pim"], rows)
    want = {("pia", "30.36", 4, 3, 0), ("pim", "11.10", 2, 2, 1)}
    for found in (audit.audit(wide, ["pia", "pim"], 2), audit.audit_texts(audit.unpivoted(wide, ["pia", "pim"]), ["pia", "pim"], 2)):
        assert {tuple(r) for r in found.collect()} == want

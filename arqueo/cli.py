"""Command line: python -m arqueo.cli ACTION PATH [options]. Exit code 0 unless something raises."""

from __future__ import annotations

import argparse
import sys
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arqueo import contracts
from arqueo.operators import audit, consolidate, duplicates, profile, quality
from arqueo.session import build_session
from arqueo.sources import config, files, landing


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _read(spark: SparkSession, a: argparse.Namespace, keep_malformed: bool = False) -> DataFrame:
    return files.read_text_csv(spark, a.path, keep_malformed=keep_malformed, encoding=a.encoding, multi_line=a.multi_line)


def _tidy_report(parts: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """control, item, metric, value, status: results of several controls as one table of texts."""
    out = []
    for control, (df, label) in parts.items():
        metrics = [c for c in df.columns if c not in (label, "status")]
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in metrics]))
        item = F.col(label) if label else F.lit(None).cast("string")
        status = F.col("status") if "status" in df.columns else F.lit(None).cast("string")
        rows = df.select(item.alias("item"), status.alias("status"), pairs.alias("m"))
        out.append(rows.select(F.lit(control).alias("control"), "item", "m.metric", "m.value", "status"))
    return reduce(DataFrame.unionByName, out)


def run_profile(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Null counts and inferred types of a sample, the classes of accrual columns (of the others null), and
    with a dictionary which columns it documents."""
    df = files.sample(_read(spark, a), a.sample_rows)
    nulls = profile.null_counts(df)
    out = nulls.join(spark.createDataFrame(list(files.inferred_types(df).items()), "column_name string, inferred_type string"), "column_name", "left")
    names = spark.createDataFrame([(c,) for c in df.columns], "column_name string")
    out = out.join(profile.classify_columns(names), "column_name", "left")
    if a.dictionary:
        known = files.read_text_csv(spark, a.dictionary, encoding=a.encoding).drop(files.CORRUPT)
        names = files.dictionary_variables(known, known.columns[0]).select(F.lower("variable").alias("column_name"))
        present = spark.createDataFrame([(c.lower(),) for c in df.columns], "column_name string")
        review = profile.name_review(names, present)
        out = out.withColumn("column_name", F.lower("column_name")).join(review, "column_name", "full")
    return out


def run_scan(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    df = _lower(_read(spark, a))
    months = [c for c in contracts.MONTHLY if c in df.columns]
    return profile.monthly_coverage(df.select(*[df[c].try_cast("decimal(24,2)").alias(c) for c in months]), months)


def _controls(df: DataFrame, a: argparse.Namespace) -> dict[str, profile.Control]:
    """The controls that the columns allow."""
    columns = [c for c in df.columns if c != files.ROW_NUMBER]
    measures = contracts.measures_of(columns) if any(c.startswith("monto_") for c in columns) else []
    months = [c for c in contracts.MONTHLY if c in columns]
    whole = bool(a.year) and contracts.YEAR in columns and len(months) == 12
    return quality.controls_of(
        columns, measures, (contracts.YEAR, a.year) if whole else None, months if whole else None, contracts.annual_of(columns) if whole else None, a.tolerance
    )


def _quality_report(found: dict[str, DataFrame]) -> DataFrame:
    labels = {"nulls": "column_name", "blanks": "column_name", "amounts": "column_name", "negatives": "column_name"}
    parts: dict[str, tuple[DataFrame, str | None]] = {k: (v, labels.get(k)) for k, v in found.items()}
    if "year" in found and "amounts" in found:
        order = ("year", "reconciliation", "nulls", "blanks", "amounts", "negatives")
        parts["summary"] = quality.quality_summary(*[found[k] for k in order]), None
    return _tidy_report(parts)


def run_quality(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """All controls that the columns allow, and their summary, from one scan."""
    df = _lower(_read(spark, a))
    watched, results = profile.observed(df, _controls(df, a))
    watched.write.format("noop").mode("overwrite").save()
    return _quality_report(results())


def run_duplicates(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The summary of equal rows with blank and malformed records; with --out, samples of them."""
    records = files.numbered_records(spark, a.path, a.encoding)
    rows = records.where("not _blank")
    names = [c for c in rows.columns if c not in (files.ROW_NUMBER, "_blank", files.CORRUPT)]
    if a.out:
        samples = duplicates.duplicate_rows(rows.select(files.ROW_NUMBER, *names), names, files.ROW_NUMBER)
        files.write_csv(samples, a.out, ["_row_hash", files.ROW_NUMBER])
    # One row on either side.
    return duplicates.duplicate_summary(rows.select(*names)).crossJoin(files.record_counts(records).drop("record_count"))


def run_grain(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    df = _lower(_read(spark, a))
    keys = {"maximal": list(contracts.MAXIMAL_KEY), "business": list(contracts.BUSINESS_KEY)}
    keys = {a.key: a.key.split(",")} if a.key else keys
    if a.out:
        numbered = _lower(files.numbered_records(spark, a.path, a.encoding)).where("not _blank")
        key = keys[duplicates.sample_key(keys)]
        samples = duplicates.collision_samples(numbered.drop("_blank", files.CORRUPT), key, [files.ROW_NUMBER])
        files.write_csv(samples, a.out, [*key, files.ROW_NUMBER])
    return duplicates.key_uniqueness(df, keys)


def run_consolidate(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Consolidate from one scan; --out gets Parquet, --csv a CSV in the order of first rows, and --quality-report
    the results of all controls, which look at the rows on their way."""
    if a.csv:
        numbered = _lower(files.numbered_records(spark, a.path, a.encoding)).where(f"not _blank and {files.CORRUPT} is null")
        df = numbered.drop("_blank", files.CORRUPT)
    else:
        df = _lower(_read(spark, a))
    names = [c for c in df.columns if c != files.ROW_NUMBER]
    key = tuple(a.key.split(",")) if a.key else contracts.BUSINESS_KEY
    grain = consolidate.Grain(key, tuple(contracts.measures_of(names)))
    controls = _controls(df, a) if a.quality_report else None
    loaded = consolidate.load(df, grain, a.tolerance, files.ROW_NUMBER if a.csv else None, controls)
    if a.quality_report:
        files.write_report(_quality_report(loaded.controls), a.quality_report)
    if a.out:
        files.write_table(loaded.rows.drop(files.ROW_NUMBER), a.out)
    if a.csv:
        files.write_csv(loaded.rows.select(*names, files.ROW_NUMBER), a.csv, [files.ROW_NUMBER], [files.ROW_NUMBER])
    report = loaded.report()
    loaded.remove()
    return report


def run_audit(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    df = _lower(_read(spark, a))
    return audit.audit(df, contracts.measures_of(df.columns), a.measures)


def run_dictionary(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Review --dictionary against the columns of a file; --expected-hash is compared with its SHA-256."""
    df = _read(spark, a)
    known = files.read_text_csv(spark, a.dictionary, encoding=a.encoding).drop(files.CORRUPT)
    names = files.dictionary_variables(known, known.columns[0]).select(F.lower("variable").alias("column_name"))
    present = spark.createDataFrame([(c.lower(),) for c in df.columns], "column_name string")
    review = profile.dictionary_review(names, present, landing.file_digest(Path(a.dictionary)), a.expected_hash or "")
    if a.out:
        names_ = profile.name_review(names, present).orderBy("column_name")
        files.markdown_report("Data dictionary", {"Summary": review, "Names": names_}).orderBy("position").select("line").coalesce(1).write.mode("overwrite").text(a.out)
    return review


def run_fetch(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Land the sources of a configuration into --out and add what happened to --manifest."""
    chosen = config.select_sources(config.load_config(a.path), a.source_id, a.all)
    manifest = landing.land(spark, chosen, Path(a.out or "."), a.force)
    if a.manifest:
        landing.append_manifest(manifest, a.manifest)
    return manifest


def run_verify(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Check landed files against the latest events of a manifest table; --quick leaves hashes out."""
    manifests = landing.read_manifests(spark, a.path)
    return landing.verify(manifests, landing.landed_files(spark, manifests), not a.quick)


ACTIONS = {n.removeprefix("run_"): f for n, f in list(globals().items()) if n.startswith("run_")}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="arqueo")
    p.add_argument("action", choices=sorted(ACTIONS))
    p.add_argument("path")
    p.add_argument("--key", help="columns, with commas between")
    p.add_argument("--out")
    p.add_argument("--report", help="folder to which the result is appended as JSON lines")
    p.add_argument("--sample-rows", type=int, default=1000)
    p.add_argument("--tolerance", default="0.01")
    p.add_argument("--encoding", default="UTF-8")
    p.add_argument("--multi-line", action="store_true", help="quoted fields may hold line breaks (duplicates and CSV outputs look for them anyway)")
    p.add_argument("--year", type=int)
    p.add_argument("--measures", type=int, help="how many amount columns there must be")
    p.add_argument("--dictionary")
    p.add_argument("--expected-hash")
    p.add_argument("--csv")
    p.add_argument("--quality-report", help="folder to which a consolidation appends the results of its controls")
    p.add_argument("--manifest")
    p.add_argument("--force", action="store_true")
    p.add_argument("--quick", action="store_true")
    p.add_argument("--source-id")
    p.add_argument("--all", action="store_true")
    a = p.parse_args(argv)
    if float(a.tolerance) < 0:
        p.error("the tolerance is negative")
    try:
        result = ACTIONS[a.action](spark or build_session(), a)
        if a.report:
            files.write_report(result, a.report)
        else:
            result.show(100, truncate=False)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

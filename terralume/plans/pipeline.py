"""The daily run over captured data at rest: four steps with manifests and gates, and a command line.

Inputs are in ``<root>/captured/<dd-mm-yyyy>``: sitemaps (``<source>*.xml``), pages of cards (``<source>*cards.jsonl`` with ``flow, page, html``), pages of
listings (``<source>*pages.jsonl`` with ``url, html, business_type``) and records already parsed (other ``<source>*.jsonl``). What is known of zip codes is in
``<root>/reference``: ``zip_base.csv``, ``zip_secondary.csv``, ``zip_answers.jsonl`` (answers fetched beforehand) and ``zip_cache.json``, which the run brings up to date.
``<root>/artifacts/<date>/<scope>/<step>`` holds outputs, ``<step>.json`` manifests and ``<step>.log``; ``<root>/history`` the store.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import json
import os
import sys
import traceback
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from glob import glob

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralume.functions import scalars
from terralume.operators import cards, enrich, incremental, latest, quality
from terralume.plans import normalize, snapshot
from terralume.sources import pages, scans, sinks

SOURCES = ["lopes", "olx", "quinto"]


@dataclass
class Check:
    name: str
    passed: bool
    message: str = ""
    severity: str = "error"


@dataclass
class Outcome:
    """What a step leaves behind; its manifest is this as JSON."""

    step: str
    status: str = "success"
    started_at: str = ""
    finished_at: str = ""
    input_manifest: str | None = None
    output_manifest: str | None = None
    log_path: str | None = None
    artifacts: list[dict] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)
    checks: list[Check] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    blocked: bool = False
    skipped: bool = False


@dataclass
class Run:
    spark: SparkSession
    root: str
    date: str
    sources: list[str] = field(default_factory=list)

    @property
    def day(self) -> datetime:
        return datetime.strptime(self.date, "%d-%m-%Y")

    @property
    def scope(self) -> str:
        chosen = sorted({s.strip().lower() for s in self.sources if s.strip()})
        return "" if not chosen else "sources__" + "__".join(chosen)

    def folder(self, scoped: bool = True) -> str:
        return os.path.join(self.root, "artifacts", self.date, *([self.scope] if scoped and self.scope else []))

    def manifest(self, step: str, scoped: bool = True) -> str:
        return os.path.join(self.folder(scoped), f"{step}.json")

    def captured(self, source: str, ending: str) -> list[str]:
        found = sorted(glob(os.path.join(self.root, "captured", self.date, f"{source}*{ending}")))
        return [f for f in found if ending != ".jsonl" or not f.endswith(("cards.jsonl", "pages.jsonl"))]

    def reference(self, name: str) -> str:
        return os.path.join(self.root, "reference", name)

    def chosen(self) -> list[str]:
        return sorted({s.strip().lower() for s in self.sources}) or SOURCES


def _artifact(name: str, path: str, rows: int, kind: str = "parquet", **more: str) -> dict:
    return {"name": name, "path": path, "format": kind, "required": True, "rows": rows, "metadata": more}


def artifacts(manifest: dict | None, role: str | None = None, kind: str | None = None, sources: list[str] | None = None) -> list[dict]:
    """Artifacts of a manifest by role, format and source; of each source and role the first."""
    chosen: dict[tuple, dict] = {}
    for a in (manifest or {}).get("artifacts", []):
        more = a.get("metadata", {})
        if (role is None or more.get("role") == role) and (kind is None or a.get("format") == kind) and (not sources or more.get("source") in sources):
            chosen.setdefault((more.get("source"), a["name"]), a)
    return list(chosen.values())


def _results(out: Outcome, name: str, empty_ok: Callable[[dict], bool], no_op_ok: bool = False) -> None:
    """Checks of a step that goes source by source: all went well, artifacts are there and hold rows."""
    results = out.metrics["source_results"]
    out.checks.append(Check(f"all_{name}_sources_succeeded", bool(results) and all(r["status"] == "success" for r in results), "each source must end well"))
    for a in out.artifacts:
        out.checks.append(Check(f"artifact_exists::{a['name']}", os.path.exists(a["path"]), a["path"]))
        out.checks.append(Check(f"artifact_non_empty::{a['name']}", a["rows"] > 0 or empty_ok(a), a["path"]))
    if not out.artifacts:
        out.checks.append(Check("artifacts_present", no_op_ok and bool(results) and all(r.get("no_op") for r in results), f"nothing came of {name}"))


def _each(run: Run, out: Outcome, work: Callable[[str], dict | None]) -> None:
    """``work`` for each source; one that fails doesn't stop the others. None: nothing was captured of it, it is left out."""
    results = []
    for source in run.chosen():
        try:
            got = work(source)
        except Exception as failure:  # noqa: BLE001 - reported in the manifest
            results.append({"source": source, "status": "failed", "error": f"{type(failure).__name__}: {failure}"[:500]})
            continue
        if got is not None:
            results.append({"source": source, "status": "success"} | got)
        else:
            print(f"[INFO] {out.step}: nothing captured of {source}, left out")
    out.metrics["source_results"] = results


def _in_file_order(spark: SparkSession, files: list[str], read: Callable[[str], DataFrame]) -> DataFrame:
    """Files one after the other, with ``_ord``: the file, then the row in it."""
    parts = [read(f).withColumn("_ord", F.lit(i).cast("bigint") * (1 << 48) + F.monotonically_increasing_id()) for i, f in enumerate(files)]
    return normalize.union_all(*parts)


def discover(run: Run, given: dict | None) -> Outcome:
    """Sitemaps and pages of cards to the links that are new or changed since the newest earlier run, source by source."""
    out = Outcome("discover")

    def links(source: str) -> dict | None:
        found, counts = None, {}
        earlier = _earlier(run, source)
        if files := run.captured(source, ".xml"):
            entries = normalize.union_all(*[scans.read_sitemap(run.spark, f) for f in files])
            found, counts = _changed(scans.discovery(entries, source).withColumn("_n", F.col("listing_url")), earlier)
        elif files := run.captured(source, "cards.jsonl"):
            found, counts = _cards(run, source, files, earlier, out)
        if found is None:
            return None
        path = os.path.join(run.folder(), "discover", source)
        sinks.write_parquet(found, path)
        rows = run.spark.read.parquet(path).count()
        out.artifacts.append(_artifact(f"{source}_links", path, rows, source=source, role="links", discovery_mode="full" if earlier is None else "delta"))
        out.metrics[source] = counts
        return {"rows": rows, "no_op": rows == 0}

    _each(run, out, links)
    out.metrics["new_links_total"] = sum(a["rows"] for a in artifacts(asdict(out), role="links"))
    _results(out, "discovery", lambda a: a["metadata"].get("discovery_mode") == "delta" or a["metadata"].get("role") == "rejects")
    return out


def _changed(current: DataFrame, earlier: DataFrame | None) -> tuple[DataFrame, dict]:
    if earlier is None:
        return current.drop("_n"), {"rows_new": current.count(), "rows_updated": 0, "rows_unchanged": 0, "rows_filtered": 0}
    before = incremental.last_state(earlier.withColumn("_n", F.col("listing_url")), ["listing_url"], "lastmod", "_n")
    day = F.try_to_date(F.left("lastmod", F.lit(10)))
    judged = incremental.classify_delta(current, before, ["listing_url"], "lastmod", day, earlier.agg(F.max(day).alias("watermark")), "_n")
    return incremental.delta(judged).drop("change", "previous", "_n"), incremental.change_counts(judged).collect()[0].asDict()


def _cards(run: Run, source: str, files: list[str], earlier: DataFrame | None, out: Outcome) -> tuple[DataFrame, dict]:
    """Pages of cards: what is kept, and the rejected ones in a file beside it."""
    read = lambda f: scans.read_jsonl(run.spark, f, scans.text_schema(["flow", "page", "html"]))
    captured = _in_file_order(run.spark, files, read).select("flow", F.col("page").try_cast("bigint").alias("page"), "html")
    found = pages.parse_card_pages(captured, "html", ["flow", "page"])
    dated = found.withColumn("listing_posted_at", scalars.card_date(F.col("raw_card_date_text"), F.lit(run.day.date())))
    schema = "listing_url string, business_type string, price_brl bigint, listing_posted_at string"
    known = run.spark.createDataFrame([], schema) if earlier is None else earlier
    prices, flows = cards.card_state(known.withColumn("_n", F.monotonically_increasing_id()), "_n")
    kept, rejected, counted = cards.run_cards(dated, prices, flows)
    bad = os.path.join(run.folder(), "discover", f"{source}_rejected.csv")
    sinks.write_rejects(rejected, bad)
    out.artifacts.append(_artifact(f"{source}_rejected", bad, rejected.count(), "csv", source=source, role="rejects"))
    sums = ["items_seen", "items_kept", "duplicates_in_run", "same_price_ignored", "invalid_records"]
    counts = counted.agg(F.count("*").alias("pages"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]).collect()[0].asDict()
    return cards.first_of_urls(kept).drop("page", "position"), counts


def _earlier(run: Run, source: str) -> DataFrame | None:
    """The links of the newest run before this one."""
    dated = []
    for path in glob(os.path.join(run.root, "artifacts", "*", "discover", source)) + glob(os.path.join(run.root, "artifacts", "*", "*", "discover", source)):
        text = os.path.relpath(path, os.path.join(run.root, "artifacts")).split(os.sep)[0]
        try:
            day = datetime.strptime(text, "%d-%m-%Y")
        except ValueError:
            continue
        if day < run.day:
            dated.append((day, path))
    for _, path in sorted(dated, reverse=True):
        df = run.spark.read.parquet(path)
        if not df.isEmpty():
            return df
    return None


def collect(run: Run, given: dict | None) -> Outcome:
    """Captured records and pages of the links that are still to be had, first of each key."""
    out = Outcome("collect")

    def records(source: str) -> dict | None:
        parts = []
        if files := run.captured(source, ".jsonl"):
            text = _in_file_order(run.spark, files, run.spark.read.text).where(F.try_parse_json("value").isNotNull() & F.col("value").rlike(r"^\s*\{"))
            columns = [r.k for r in text.select(F.explode(F.json_object_keys("value")).alias("k")).distinct().orderBy("k").collect()]
            if columns:
                parts.append(text.select(F.from_json("value", scans.text_schema(columns)).alias("r"), "_ord").select("r.*", "_ord"))
        if files := run.captured(source, "pages.jsonl"):
            read = lambda f: scans.read_jsonl(run.spark, f, scans.text_schema(["url", "html", "business_type"]))
            captured = _in_file_order(run.spark, files, read).withColumn("_key", F.col("_ord").cast("string"))
            parsed = pages.parse_pages(captured, source, "html", "url", "business_type", "_key")
            parts.append(parsed.withColumn("_ord", F.col("key").cast("bigint")).drop("key"))
        if not parts:
            return None
        whole = normalize.union_all(*parts)
        for c in ("source", "business_type", "property_id", "listing_id", "listing_url"):
            if c not in whole.columns:
                whole = whole.withColumn(c, F.lit(None).cast("string"))
        keyed = whole.withColumn("property_id", F.coalesce("property_id", "listing_id")).withColumn("source", F.coalesce("source", F.lit(source)))
        kept = latest.dedupe_records(keyed.where(latest.required_key("business_type", "property_id", "listing_url")), "source", "business_type", "property_id", "listing_url", "_ord")
        path = os.path.join(run.folder(), "collect", source)
        sinks.write_parquet(kept, path)
        rows = run.spark.read.parquet(path).count()
        out.artifacts.append(_artifact(f"{source}_records", path, rows, source=source, role="records"))
        return {"rows": rows}

    _each(run, out, records)
    out.metrics["rows_total"] = sum(a["rows"] for a in out.artifacts)
    _results(out, "collection", lambda a: False, no_op_ok=True)
    return out


def _dimension(run: Run, name: str, tag: str) -> DataFrame:
    empty = "zip string, street string, neighbourhood string, city string, state string, lat double, lon double, source string"
    if not os.path.exists(run.reference(name)):
        return run.spark.createDataFrame([], empty)
    read = scans.read_csv(run.spark, run.reference(name)).withColumn("_n", F.monotonically_increasing_id())
    return scans.zip_reference(read, "_n").withColumn("source", F.lit(tag))


def enriched(run: Run, listings: DataFrame, out: Outcome, resolver: Callable[[Run], DataFrame] | None = None) -> DataFrame:
    """Gaps filled from zip codes; the cache is brought up to date. ``resolver`` gives answers fetched beforehand (default: their file)."""
    base, secondary = _dimension(run, "zip_base.csv", "base_ceps"), _dimension(run, "zip_secondary.csv", "cepaberto")
    schema = "zip string, street string, neighbourhood string, city string, state string, lat double, lon double, source string"
    path, fetched = run.reference("zip_cache.json"), run.reference("zip_answers.jsonl")
    cache = scans.zip_cache(run.spark, path) if os.path.exists(path) else run.spark.createDataFrame([], schema + ", failed boolean")
    answers = resolver(run) if resolver else run.spark.read.schema(schema).json(fetched) if os.path.exists(fetched) else run.spark.createDataFrame([], schema)
    if base.isEmpty() and secondary.isEmpty() and cache.isEmpty() and answers.isEmpty():
        print("[INFO] snapshot: nothing is known of zip codes, nothing is filled")
        return listings
    filled, got, counts = enrich.enrich_listings(listings, cache, base, secondary, answers)
    out.metrics["enrichment"] = counts.collect()[0].asDict()
    kept = cache.join(got.select("zip"), "zip", "left_anti").unionByName(got.select(*cache.columns))
    sinks.write_zip_cache(enrich.cache_entries(kept), path)
    return filled


def build_snapshot(run: Run, given: dict | None) -> Outcome:
    """Records to the three tables of the day, gaps filled from zip codes first."""
    out = Outcome("snapshot")
    paths = [a["path"] for a in artifacts(given, role="records", sources=run.chosen() if run.sources else None)]
    if not paths:
        raise ValueError("the input manifest names no records")
    raw = normalize.union_all(*[run.spark.read.parquet(p).withColumn("_ord", F.lit(i).cast("bigint") * (1 << 56) + F.col("_ord")) for i, p in enumerate(paths)])
    listings = enriched(run, normalize.normalize(raw, F.lit(run.day.replace(tzinfo=timezone.utc).isoformat())), out)
    folder = os.path.join(run.folder(), "snapshot")
    for name, df in snapshot.snapshot(listings, keep_ordinal=True).items():
        path = os.path.join(folder, name)
        # the order of rows stays with them: it decides ties in the store
        sinks.write_parquet(normalize.without_long_text(df).withColumnRenamed("_ord", "row_order") if name == "listings" else df, path)
        out.artifacts.append(_artifact(name, path, run.spark.read.parquet(path).count()))
    table = {a["name"]: run.spark.read.parquet(a["path"]) for a in out.artifacts}
    for name in ("listings", "properties"):
        path = os.path.join(folder, f"{name}.csv")
        sinks.export_csv_file(table[name].drop("row_order"), path)
        out.artifacts.append(_artifact(f"{name}_csv", path, next(a["rows"] for a in out.artifacts if a["name"] == name), "csv"))
    out.metrics |= {f"{name}_rows": df_rows for name, df_rows in ((a["name"], a["rows"]) for a in out.artifacts if a["format"] == "parquet")}
    out.checks += snapshot_checks(table)
    out.checks += [Check(f"artifact_exists::{a['name']}", os.path.exists(a["path"]), a["path"]) for a in out.artifacts]
    return out


def snapshot_checks(table: dict[str, DataFrame]) -> list[Check]:
    """Whether the day's tables hold what they must: canonical columns, rows, keys on every row, links to known properties."""
    lacking = [c for c in normalize.CANONICAL if c not in normalize.LONG_TEXT and c not in table["listings"].columns]
    keyed = F.col("source").isNotNull() & latest.required_key("business_type", "property_id", "listing_url")
    report = quality.row_checks(table["listings"], {"keyed": keyed}).collect()[0]
    whole = not table["links"].isEmpty() and quality.orphans(table["links"], table["properties"], "canonical_property_id", "canonical_property_id").isEmpty()
    return [Check("canonical_columns", not lacking, ", ".join(lacking)), Check("not_empty", report["rows"] > 0), Check("business_keys", report["rows"] > 0 and report["keyed"]), Check("links_have_properties", whole)]


def update_history(run: Run, given: dict | None) -> Outcome:
    """The day's listings into the store: upsert, and the entity tables made anew."""
    out = Outcome("history")
    named = {a["name"]: a["path"] for a in artifacts(given, kind="parquet")}
    if "listings" not in named:
        raise ValueError("the input manifest names no listings")
    if gone := [n for n in ("listings", "properties", "links") if n not in named or not os.path.exists(named[n])]:
        raise FileNotFoundError(f"tables of the day are not there: {', '.join(gone)}")
    incoming = run.spark.read.parquet(named["listings"]).withColumnRenamed("row_order", "_ord")
    if run.sources:
        incoming = incoming.where(F.col("source").isin(run.chosen()))
        if incoming.isEmpty():
            raise ValueError("the day has no listing of these sources")
    drop = [c for c in incoming.columns if c.startswith("listing_") and c != "listing_url" and c != "listing_created_at"] + ["is_for_sale", "is_for_rent", "canonical_property_id"]
    incoming = incoming.drop(*drop)
    store = os.path.join(run.root, "history", "listings")
    existing = run.spark.read.parquet(store).drop(*drop).withColumnRenamed("row_order", "_ord") if os.path.exists(store) else incoming.limit(0)
    tables, counts = snapshot.update_history(existing, incoming, F.lit(run.day))
    out.metrics = counts.collect()[0].asDict()
    out.metrics["incoming_keys"] = incoming.select(*snapshot.UPSERT_KEY).distinct().count()
    for name, df in tables.items():
        target = os.path.join(run.root, "history", name)
        sinks.swap_in(df.withColumnRenamed("_ord", "row_order"), target)
        out.artifacts.append(_artifact(name, target, run.spark.read.parquet(target).count()))
    sinks.export_csv_file(run.spark.read.parquet(os.path.join(run.root, "history", "properties")), os.path.join(run.root, "history", "properties.csv"))
    listings = run.spark.read.parquet(store)
    out.checks.append(Check("keys_add_up", out.metrics["incoming_keys"] == out.metrics["inserted"] + out.metrics["updated"]))
    out.checks.append(Check("unique_keys", quality.duplicate_keys(listings, snapshot.UPSERT_KEY).isEmpty()))
    out.checks.append(Check("history_columns", {"first_seen_at", "last_seen_at", "created_at", "updated_at"} <= set(listings.columns)))
    return out


def recover(run: Run, source: str) -> dict:
    """Links of the day without a record, for another round (``missing``), and records of that round, captured as
    ``<source>*recovered.jsonl``, put behind those there are (``recovered``). The step before the snapshot is then that table."""
    links = run.spark.read.parquet(os.path.join(run.folder(), "discover", source))
    path = os.path.join(run.folder(), "collect", source)
    have = run.spark.read.parquet(path)
    id_of = F.coalesce(F.col("listing_id"), scalars.id_from_url(F.col("listing_url"))) if "listing_id" in links.columns else scalars.id_from_url(F.col("listing_url"))
    missing = incremental.missing_ids(links.withColumn("property_id", id_of), have.where(F.col("property_id").rlike(r"\S")), "property_id")
    sinks.write_parquet(missing, f"{path}_missing")
    counts = {"links": links.count(), "collected": have.count(), "missing": run.spark.read.parquet(f"{path}_missing").count(), "recovered": 0}
    if files := run.captured(source, "recovered.jsonl"):
        read = lambda f: scans.read_jsonl(run.spark, f, scans.text_schema([c for c in have.columns if c != "_ord"]))
        both = incremental.recover(have, _in_file_order(run.spark, files, read), "property_id", "listing_url", "_ord")
        sinks.swap_in(both, path)
        counts["recovered"] = run.spark.read.parquet(path).count() - counts["collected"]
    return counts


STEPS: dict[str, Callable[[Run, dict | None], Outcome]] = {"discover": discover, "collect": collect, "snapshot": build_snapshot, "history": update_history}
#: Steps that read the manifest of the one before them.
NEEDS = {"snapshot": "collect", "history": "snapshot"}


class _Both(io.TextIOBase):
    """Writes to a log and to where it went before."""

    def __init__(self, *targets: io.TextIOBase):
        self.targets = targets

    def write(self, text: str) -> int:
        for t in self.targets:
            t.write(text)
        return len(text)

    def flush(self) -> None:
        for t in self.targets:
            t.flush()


def run_step(run: Run, step: str, input_manifest: str | None = None) -> Outcome:
    """One step and its manifest. Errors and failed checks of severity ``error`` block what follows."""
    started = datetime.now(timezone.utc).isoformat()
    source = input_manifest or _input(run, step)
    log = os.path.join(run.folder(), f"{step}.log")
    os.makedirs(run.folder(), exist_ok=True)
    try:
        with open(log, "w", encoding="utf-8") as file, contextlib.redirect_stdout(_Both(file, sys.stdout)):
            print(f"[INFO] {step}: start, input {source}")
            out = STEPS[step](run, sinks.read_json(source) if source else None)
            for c in out.checks:
                print(f"[{'INFO' if c.passed else 'ERROR'}] {step}: check {c.name} {'passed' if c.passed else 'failed'} {c.message}")
        if any(not c.passed and c.severity == "error" for c in out.checks):
            out.status, out.blocked = "failed", True
    except Exception as failure:  # noqa: BLE001 - the manifest tells what happened
        out = Outcome(step, "failed", errors=[f"{type(failure).__name__}: {failure}"[:2000]], blocked=True)
        with open(log, "a", encoding="utf-8") as file:
            traceback.print_exc(file=file)
        traceback.print_exc(limit=3)
    out.log_path = log
    out.started_at, out.finished_at, out.input_manifest, out.output_manifest = started, datetime.now(timezone.utc).isoformat(), source, run.manifest(step)
    sinks.write_json(asdict(out), out.output_manifest)
    return out


def _input(run: Run, step: str) -> str | None:
    """The manifest of the step before, of the same sources, else of all."""
    if step not in NEEDS:
        return None
    for scoped in (True, False):
        path = run.manifest(NEEDS[step], scoped)
        if os.path.exists(path):
            return path
    raise FileNotFoundError(f"{step} needs the manifest of {NEEDS[step]}")


def run_all(run: Run, start: str | None = None, force_discovery: bool = False) -> dict:
    """All steps in order, from ``start`` on. A successful discovery of the day is used again unless forced; without new links nothing follows."""
    names = list(STEPS)
    names = names[names.index(start) :] if start else names
    results, reason, status = [], None, "success"
    for name in names:
        known = sinks.read_json(run.manifest(name)) if name == "discover" and not start and not force_discovery and os.path.exists(run.manifest(name)) else None
        result = known | {"skipped": True} if known and known.get("status") == "success" else asdict(run_step(run, name))
        results.append(result)
        if result["status"] != "success" and result["blocked"]:
            status, reason = "failed", f"blocked_by_{name}"
            break
        if name == "discover" and not result["metrics"].get("new_links_total"):
            reason = "no_new_links_after_discovery"
            break
    summary = {"date": run.date, "status": status, "stop_reason": reason, "results": results}
    sinks.write_json(summary, os.path.join(run.folder(), "run.json"))
    return summary


def export_source(root: str, given: str | None, date: str | None) -> str:
    """The table to export: the one given, else the day's listings, else the store's."""
    return given or (os.path.join(root, "artifacts", date, "snapshot", "listings") if date else os.path.join(root, "history", "listings"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Daily run over captured listing data")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list-steps")
    for name in ("run-all", "run-step", "recover"):
        p = commands.add_parser(name)
        p.add_argument("--root", default=".")
        p.add_argument("--date", default=datetime.now().strftime("%d-%m-%Y"))
        p.add_argument("--sources", nargs="+", choices=SOURCES, default=[])
    commands.choices["run-all"].add_argument("--from-step", choices=list(STEPS))
    commands.choices["run-all"].add_argument("--force-discovery", action="store_true")
    commands.choices["run-step"].add_argument("step", choices=list(STEPS))
    commands.choices["run-step"].add_argument("--input-manifest")
    commands.choices["recover"].add_argument("source", choices=SOURCES)
    export = commands.add_parser("export-csv")
    export.add_argument("--input")
    export.add_argument("--date")
    export.add_argument("--root", default=".")
    export.add_argument("--output")
    args = parser.parse_args(argv)
    if args.command == "list-steps":
        print(*STEPS, sep="\n")
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.command == "export-csv":
        source = export_source(args.root, args.input, args.date)
        sinks.export_csv_file(spark.read.parquet(source), args.output or f"{source.rstrip('/')}.csv")
        return 0
    run = Run(spark, args.root, args.date, args.sources)
    if args.command == "recover":
        print(json.dumps(recover(run, args.source), indent=2))
        return 0
    if args.command == "run-step":
        result = asdict(run_step(run, args.step, args.input_manifest))
    else:
        result = run_all(run, args.from_step, args.force_discovery)
    print(json.dumps(result, indent=2, ensure_ascii=False, default=str))
    return int(result["status"] != "success")


if __name__ == "__main__":
    sys.exit(main())

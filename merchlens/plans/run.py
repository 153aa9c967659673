"""The batch run from raw files to dashboards: named steps that hand over through tables in one shared folder.

Every step can run alone once the steps before it have run. Intermediate tables are written, not cached, so a lost
executor costs the tasks it was running and a later step never recomputes an earlier one. Independent reports are
submitted side by side from driver threads; Spark interleaves their stages.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions.metrics import Calendar
from merchlens.operators import cleaning, keys, profiling, quality, validation
from merchlens.plans import operations, regional, sales
from merchlens.plans.dashboards import (
    operations_dashboard,
    regional_dashboard,
    sales_dashboard,
)
from merchlens.plans.model import MONTH, SalesModel, category_base, order_base, order_facts, order_months
from merchlens.session import build_session
from merchlens.sources import clean_store, exports, files
from merchlens.sources.jobs import side_by_side
from merchlens.sources.raw_csv import FILE, RawDataError, RawFolder
from merchlens.sources.schemas import CLEAN_DATASETS
from merchlens.sources.states import state_reference

DASHBOARDS = ("sales_dashboard", "operations_dashboard", "regional_dashboard", "data_quality_summary")
# In dependency order.
VIEWS = ("state_reference", "order_facts", *DASHBOARDS)
REPORTS = {"sales": sales.REPORTS, "operations": operations.REPORTS, "regional": regional.REPORTS}
ITEMS_PER_BUCKET = 1_000_000
HEADLINES = ("total_revenue", "total_orders", "average_order_value", "operations_kpis")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for written tables."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("Name a work folder, or set spark.checkpoint.dir to a folder every executor can reach")
    return f"{folder.rstrip('/')}/merchlens"


@dataclass(frozen=True)
class Run:
    """A raw folder and the work folder of one run."""

    spark: SparkSession
    raw: RawFolder
    folder: str
    calendar: Calendar = Calendar()
    domains: validation.Domains = validation.Domains()
    states: DataFrame | None = None
    # Whether profiles count distinct values exactly, or merge kept states of the files, which estimate them.
    exact_unique: bool = True
    # How many publications, sets of views and ingested copies stay for readers; None keeps all.
    keep: int | None = 2
    # Buckets of the stored facts; by the number of items, up to the session's shuffle partitions, where unset.
    buckets: int | None = None
    # Where the views are registered; the session's current database where unset.
    database: str | None = None

    # ---- tables handed from step to step

    def raw_tables(self, ordered: bool = False) -> dict[str, DataFrame]:
        """The raw datasets as ingested by `check_raw_data`, which runs first where the files as they are now have not been.

        The ingested copy is named after the files' sizes and times, so a step never reads that of older files.
        `ordered` keeps the place of each row.
        """
        folder = f"{self.folder}/raw/{self.raw.fingerprint(self.spark)}"
        if not self._complete(folder):
            self.check_raw_data()
        return {name: self.raw.ingested(self.spark, name, f"{folder}/{name}", ordered) for name in self.raw.files}

    def _complete(self, folder: str) -> bool:
        """Whether every table of a folder was written; the marker comes last."""
        try:
            return not self.spark.read.parquet(f"{folder}/complete").isEmpty()
        except AnalysisException:
            return False

    def _mark_complete(self, folder: str) -> None:
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/complete")

    def clean(self) -> dict[str, DataFrame]:
        """The clean tables of the files as they are now: the rows `clean_data` keeps, without the staging columns."""
        folder = f"{self.folder}/staged/{self.raw.fingerprint(self.spark)}"
        if not self._complete(folder):
            self.clean_data()
        tables = {}
        for name in CLEAN_DATASETS:
            staged = self.spark.read.parquet(f"{folder}/{name}")
            kept = [column for column in staged.columns if not column.startswith("_")]
            tables[name] = staged.where(cleaning.KEPT).select(*kept)
        return tables

    def model(self) -> SalesModel:
        """The sales model over the newest published tables."""
        tables = clean_store.published(self.spark, f"{self.folder}/warehouse")
        return SalesModel(
            **{name: tables[name] for name in CLEAN_DATASETS},
            facts=tables["order_base"],
            category_facts=tables["category_base"],
            states=self.states if self.states is not None else state_reference(self.spark),
            calendar=self.calendar,
        )

    def key_profiles(self) -> dict[str, DataFrame]:
        """The profiles of the newest published tables' keys."""
        tables = clean_store.published(self.spark, f"{self.folder}/warehouse")
        return {name: tables[name] for name in keys.PROFILES}

    def views(self) -> dict[str, DataFrame]:
        """The newest complete set written by `create_views`."""
        return clean_store.published(self.spark, f"{self.folder}/views")

    def column_states(self, dataset: str) -> DataFrame:
        """The profile states of a dataset's files as they are now; only files without kept states are read.

        States are kept under the files' versions and never change, so a state written twice counts once.
        """
        folder, kept = f"{self.folder}/raw/{self.raw.fingerprint(self.spark)}", f"{self.folder}/profile_states/{dataset}"
        versions = self.raw.versions(self.spark, dataset)

        def known() -> DataFrame | None:
            try:
                return self.spark.read.parquet(kept).where(F.col("version").isin(*versions.values())).dropDuplicates(["version", "column_name"])
            except AnalysisException:
                return None

        found = known()
        have = set() if found is None else {r.version for r in found.select("version").distinct().collect()}
        fresh = [(path, version) for path, version in versions.items() if version not in have]
        if fresh:
            rows = self.raw.ingested(self.spark, dataset, f"{folder}/{dataset}", files=True)
            # One row per file.
            named = self.spark.createDataFrame(fresh, f"{FILE} string, _version string")
            states = profiling.column_states(rows.join(F.broadcast(named), FILE).drop(FILE), "_version")
            states.write.mode("append").parquet(kept)
        return known()

    # ---- steps

    def check_raw_data(self) -> dict[str, int]:
        """Check the raw files and ingest them; returns their sizes and raises with every problem found.

        The text is parsed once and kept unchanged in columns, so that profiling and cleaning, which read every
        dataset several times, each read only the columns they need. Rows that do not fit their header are counted by
        the tasks that parse them; where there are any, they are listed in one table before the error is raised.
        """
        folder = f"{self.folder}/raw/{self.raw.fingerprint(self.spark)}"
        sizes, problems = self.raw.inspect(self.spark)

        def ingest(name: str) -> dict[str, int]:
            # Only repeated translations are told apart by their place.
            return self.raw.ingest(self.spark, name, f"{folder}/{name}", ordered=name == "category_translation")

        counts = dict(zip(sizes, side_by_side(self.spark, ingest, sizes)))
        broken = {name: {reason: n for reason, n in found.items() if n} for name, found in counts.items() if any(found.values())}
        if broken:
            parts = [self.raw.rejected(self.spark, name, f"{folder}/{name}") for name in broken]
            reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{folder}/rejected")
            for name, found in broken.items():
                listed = ", ".join(f"{n} ({reason})" for reason, n in found.items())
                problems.append(f"{name}: {sum(found.values())} rows that do not fit the header: {listed}; see {folder}/rejected")
        if problems:
            raise RawDataError("Raw data check failed:\n" + "\n".join(problems))
        self._mark_complete(folder)
        return sizes

    def profile_data(self) -> dict[str, int]:
        raw = self.raw_tables()
        if self.exact_unique:
            datasets, columns = profiling.profile_all(raw)
        else:
            datasets = reduce(DataFrame.unionByName, [profiling.profile_dataset(name, data) for name, data in raw.items()])
            merged = [profiling.merged_profile(name, data.columns, self.column_states(name)) for name, data in raw.items()]
            columns = reduce(DataFrame.unionByName, merged)
        # The columns are profiled once; what follows from their profiles is read from the written ones.
        exports.write_json(columns, f"{self.folder}/profile/columns")
        columns = self.spark.read.schema(columns.schema).json(f"{self.folder}/profile/columns")
        names = [F.struct(F.lit(self.raw.files[n]).alias("file_name"), F.lit(", ".join(raw[n].columns)).alias("columns")) for n in raw]
        described = F.element_at(F.map_from_arrays(F.array(*[F.lit(n) for n in raw]), F.array(*names)), F.col("dataset"))
        reports = {
            "datasets": datasets.select("*", described.alias("described")).select(*datasets.columns, "described.*"),
            "date_ranges": profiling.date_ranges(columns),
            "missing_values": profiling.missing_values(columns),
            "order_status": profiling.status_distribution(raw["orders"]),
            "missing_timestamps": profiling.missing_timestamps_by_status(raw["orders"]),
            "untranslated_categories": profiling.untranslated_categories(
                raw["products"], raw["category_translation"]
            ),
            "value_checks": profiling.raw_value_checks(raw),
        }
        side_by_side(self.spark, lambda name: exports.write_json(reports[name], f"{self.folder}/profile/{name}"), reports)
        written = self.spark.read.json(f"{self.folder}/profile/datasets")
        return {row.dataset: row.row_count for row in written.collect()}

    def clean_data(self) -> dict[str, dict[str, int]]:
        folder = f"{self.folder}/staged/{self.raw.fingerprint(self.spark)}"
        tables = cleaning.clean_all(self.raw_tables(ordered=True))
        staged = dict(zip(tables, side_by_side(self.spark, lambda n: tables[n].stage(f"{folder}/{n}"), tables)))
        self._mark_complete(folder)
        summary = cleaning.cleaning_summary(staged)
        reports = {
            "summary": summary,
            "actions": cleaning.cleaning_actions(staged),
            "missing_values": cleaning.missing_value_report(staged),
        }
        side_by_side(self.spark, lambda name: exports.write_json(reports[name], f"{self.folder}/cleaning/{name}"), reports)
        return {
            row.dataset: {
                "rows_after": row.rows_after, "rows_removed": row.rows_removed, "rows_modified": row.rows_modified,
            }
            for row in self.spark.read.json(f"{self.folder}/cleaning/summary").collect()
        }

    def validate_data(self) -> dict[str, int]:
        """Rule outcomes; raises when a critical rule is broken.

        The constraints of the published tables are evaluated along with the rules, and kept for `load_tables`.
        """
        path, outcomes = f"{self.folder}/validation", f"{self.folder}/outcomes/{self.raw.fingerprint(self.spark)}"
        clean = self.clean()
        # Grouped here once; rules and constraints, the publication and the data quality of the views read the profiles.
        profiles = keys.key_profiles(clean)
        side_by_side(self.spark, lambda n: profiles[n].coalesce(1).write.mode("overwrite").parquet(f"{outcomes}/{n}"), profiles)
        kept = {name: self.spark.read.parquet(f"{outcomes}/{name}") for name in profiles}
        validation.check_everything(clean, self.domains, kept).coalesce(1).write.mode("overwrite").parquet(f"{outcomes}/rows")
        self._mark_complete(outcomes)
        rules = self.spark.read.parquet(f"{outcomes}/rows").where("is_rule").drop("is_rule").orderBy("position")
        exports.write_json(rules, path)
        results = validation.gate(self.spark.read.json(path))
        return {row.status: row["count"] for row in results.groupBy("status").count().collect()}

    def load_tables(self) -> dict[str, int]:
        """Publish the clean tables as one set, after the constraints of the published tables hold.

        The items are placed by their order's month and bucketed by order, and so are two tables that are derived once
        for all reports: the items added up per order and category, and everything known of an order. Sets and ingested
        copies beyond `keep` expire.
        """
        clean = self.clean()
        outcomes = f"{self.folder}/outcomes/{self.raw.fingerprint(self.spark)}"
        profiles = None
        if self._complete(outcomes):
            constraints = self.spark.read.parquet(f"{outcomes}/rows").where("NOT is_rule")
            profiles = {name: self.spark.read.parquet(f"{outcomes}/{name}") for name in keys.PROFILES}
        else:
            constraints = validation.check_constraints(clean)
        validation.gate(constraints)
        # One bucket per million items, no more than a shuffle would have: small tables would only get many tiny files.
        most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = self.buckets or min(most, 1 + clean["order_items"].count() // ITEMS_PER_BUCKET)
        layout = clean_store.Layout(MONTH, "order_id", buckets)

        def items_by_month(items: DataFrame, tables: Mapping[str, DataFrame]) -> clean_store.LaidOut:
            return clean_store.LaidOut(items.join(order_months(tables["orders"]), "order_id", "left"), layout)

        def per_category(tables: Mapping[str, DataFrame]) -> dict[str, clean_store.LaidOut]:
            base = category_base(tables["order_items"], tables["products"], tables["orders"])
            return {"category_base": clean_store.LaidOut(base, layout)}

        def per_order(tables: Mapping[str, DataFrame]) -> dict[str, clean_store.LaidOut]:
            base = order_base(tables["orders"], tables["customers"], tables["category_base"])
            return {"order_base": clean_store.LaidOut(base, layout)}

        def per_key(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
            found = profiles or keys.key_profiles(tables)
            return {name: data.coalesce(1) for name, data in found.items()}

        counts = clean_store.publish(
            self.spark, clean, f"{self.folder}/warehouse", {"order_items": items_by_month},
            [per_category, lambda tables: {**per_order(tables), **per_key(tables)}],
        )
        if self.keep is not None:
            clean_store.expire(self.spark, f"{self.folder}/warehouse", self.keep)
            self._expire_copies(self.keep)
        return counts

    def _expire_copies(self, keep: int) -> None:
        """Delete the ingested and staged copies of all but the newest `keep` states of the raw files."""
        for kind in ("raw", "staged", "outcomes"):
            changed = files.folders(self.spark, f"{self.folder}/{kind}")
            # A copy without its marker is being written.
            done = {n: files.folders(self.spark, f"{self.folder}/{kind}/{n}").get("complete") for n in changed}
            newest = sorted((at, n) for n, at in done.items() if at is not None)
            for _, name in newest[:-keep]:
                files.remove(self.spark, f"{self.folder}/{kind}/{name}")

    def create_views(self) -> list[str]:
        """Write the order facts and every dashboard once, require rows, and register them as views.

        They go to a folder of their own that becomes visible as a whole, so no reader meets views of different runs.
        All of them read the stored facts. The catalog's views are replaced in dependency order, and sets beyond `keep`
        expire.
        """
        model = self.model()
        built = {
            "state_reference": model.states,
            "order_facts": order_facts(model),
            "sales_dashboard": sales_dashboard(model),
            "regional_dashboard": regional_dashboard(model),
            "data_quality_summary": quality.data_quality_summary(model.tables(), model.states, self.key_profiles()),
        }

        root = f"{self.folder}/views"
        number, folder = clean_store.new_folder(self.spark, root)
        seen = clean_store.write_marked(self.spark, built, folder)
        facts = self.spark.read.parquet(f"{folder}/order_facts")
        seen |= clean_store.write_marked(self.spark, {"operations_dashboard": operations_dashboard(facts)}, folder)
        views = {name: self.spark.read.parquet(f"{folder}/{name}") for name in VIEWS}
        clean_store.verify_content(self.spark, seen, views)
        exports.require_rows({name: views[name] for name in DASHBOARDS})
        clean_store.point_to(self.spark, root, number, folder, VIEWS)
        names = exports.refresh_views(self.spark, {name: f"{folder}/{name}" for name in VIEWS}, self.database)
        if self.keep is not None:
            clean_store.expire(self.spark, root, self.keep)
        return names

    def run_sales_analysis(self) -> dict[str, int]:
        return self._export_reports("sales", sales.REPORTS)

    def run_operations_analysis(self) -> dict[str, int]:
        return self._export_reports("operations", operations.REPORTS)

    def run_regional_analysis(self) -> dict[str, int]:
        return self._export_reports("regional", regional.REPORTS)

    def export_dashboards(self) -> dict[str, int]:
        views = self.views()
        written = side_by_side(
            self.spark,
            lambda name: exports.export_dashboards({name: views[name]}, f"{self.folder}/dashboards"),
            DASHBOARDS,
        )
        return {name: rows for part in written for name, rows in part.items()}

    def generate_summary(self) -> dict[str, object]:
        """Row counts, rule outcomes and headline figures of the run, as one JSON document."""
        model = self.model()
        reports = {**sales.REPORTS, **operations.REPORTS}
        figures = side_by_side(self.spark, lambda name: reports[name](model).first().asDict(), HEADLINES)
        outcomes = self.spark.read.json(f"{self.folder}/validation").groupBy("status").count()
        summary = {
            "generated_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
            "table_row_counts": clean_store.count_rows(model.tables()),
            "validation_status_counts": {row.status: row["count"] for row in outcomes.collect()},
            "headline_metrics": dict(zip(HEADLINES, figures)),
        }
        text = json.dumps(summary, default=lambda v: float(v) if isinstance(v, Decimal) else str(v))
        document = self.spark.createDataFrame([(text,)], "value string").coalesce(1)
        document.write.mode("overwrite").text(f"{self.folder}/summary")
        return summary

    def _export_reports(self, group: str, reports: Mapping[str, Callable[[SalesModel], DataFrame]]) -> dict[str, int]:
        """One CSV per report; returns the rows of each."""
        model, folder = self.model(), f"{self.folder}/reports/{group}"

        def export(name: str) -> int:
            return exports.export_results({name: reports[name](model)}, folder)[name]

        return dict(zip(reports, side_by_side(self.spark, export, reports)))

    def run_report(self, name: str) -> dict[str, int]:
        """Export one named report over the published tables; returns its rows."""
        for group, reports in REPORTS.items():
            if name in reports:
                return self._export_reports(group, {name: reports[name]})
        raise ValueError(f"Unknown report: {name}. Choose from: {sorted(n for reports in REPORTS.values() for n in reports)}")


# Names of the steps.
STEPS = (
    "check_raw_data",
    "profile_data",
    "clean_data",
    "validate_data",
    "load_tables",
    "create_views",
    "run_sales_analysis",
    "run_operations_analysis",
    "run_regional_analysis",
    "export_dashboards",
    "generate_summary",
)


def run(batch: Run, steps: Iterable[str] | None = None) -> dict[str, object]:
    """Run the named steps in the given order, or all of them; returns what each step reports."""
    names = list(steps) if steps else list(STEPS)
    unknown = [name for name in names if name not in STEPS]
    if unknown:
        raise ValueError(f"Unknown step(s): {unknown}. Choose from: {list(STEPS)}")
    return {name: getattr(batch, name)() for name in names}


if __name__ == "__main__":
    parser = argparse.ArgumentParser(prog="python -m merchlens.plans.run")
    parser.add_argument("folder", help="folder of the raw files")
    parser.add_argument("steps", nargs="*", help="steps to run, all by default")
    parser.add_argument("--report", help="export this report over the published tables instead of running steps")
    chosen = parser.parse_args()
    session = build_session()
    batch = Run(session, RawFolder(chosen.folder), shared_folder(session))
    report = batch.run_report(chosen.report) if chosen.report else run(batch, chosen.steps or None)
    print(json.dumps(report, default=str, indent=2))

"""The full and the partial run, from landed tables to published suggestions.

Every stage writes a table in the run's folder and the next one reads it, so a lost
executor costs a stage at most and a table's size is known when it is joined. A run
writes nowhere else until it is published, so one that dies changes nothing, and the
same run may be repeated.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import sites
from ..operators import (
    clean, extract, forest, incremental, market, offers, pricing, searchplan, training,
)
from ..operators.joins import lookup_join
from ..sources import erp, files, tables
from ..sources.store import RunState, SuggestionStore


@dataclass
class Landed:
    """Landed inputs.

    ``catalog`` has a column ``seq``, the order of the export; ``pages``: site, search_keyword, search_mode, url, html, position (order of
    the hit); ``modifiers`` may be missing.
    """

    catalog: DataFrame
    lines: DataFrame
    orders: DataFrame
    competitors: DataFrame
    pages: DataFrame
    modifiers: DataFrame | None = None


@dataclass
class Settings:
    quote_year: int
    company: str = training.OWN_COMPANY
    trees: int = forest.TREES
    max_depth: int = forest.MAX_DEPTH


class PriceRun:
    """Runs over one base folder; ``run_id`` names a run and makes it repeatable."""

    def __init__(self, spark: SparkSession, base: str, settings: Settings):
        self.spark = spark
        self.base = base.rstrip("/")
        self.settings = settings
        self.state = RunState(spark, self.base)
        self.store = SuggestionStore(spark, self.base)
        # Rows written per stage of the last run, counted while writing.
        self.row_counts: dict[str, int] = {}

    def run(self, landed: Landed, run_id: str, now: dt.datetime, mode: str | None = None) -> str:
        """Run in the given mode, or in the one the last full run calls for.

        Returns 'full', 'partial', or 'nothing new'.
        """
        mode = mode or incremental.run_mode(self.state.last_full_run(), now)
        self.run_id = run_id
        earlier = self.state.current_runs() if mode == "partial" else []
        self.offer_runs = [*(r for r in earlier if r != run_id), run_id]
        catalog = self._stage(erp.catalog(landed.catalog), "catalog")
        wanted = catalog
        if mode == "partial":
            since = self.state.require_last_full_run()
            wanted = incremental.new_products(catalog, since)
            if wanted.isEmpty():
                return "nothing new"

        self._collect_offers(wanted, landed, now)
        quotes = self._stage(
            erp.quotes(erp.sale_lines(landed.lines, landed.orders, self.settings.quote_year)),
            "quotes",
        )
        volume, units = self._clean(erp.manual_offers(landed.competitors))
        types = self._stage(market.known_types(volume, units), "known_types")
        self._train(volume, units, quotes, training.predictable_products(catalog, types))
        report = self._predict(training.predictable_products(wanted, types), quotes)
        records = pricing.upload_records(report)
        tables.write_table(
            records.filter(F.col("reject_reason").isNotNull()), self._path("rejected")
        )
        self.store.publish(records.filter(F.col("reject_reason").isNull()), run_id, mode, now)
        self.state.finished(run_id, mode, now)
        return mode

    def _path(self, name: str) -> str:
        return f"{self.base}/runs/{self.run_id}/{name}"

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self._path(name)
        seen = Observation(name)
        tables.write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
        self.row_counts[name] = seen.get["rows"]
        return self.spark.read.parquet(path)

    def loss_products(self) -> DataFrame:
        """How many suggested prices of the last report do not exceed the cost."""
        return pricing.loss_count(self.read("report"))

    def read(self, name: str) -> DataFrame:
        """A stage of the last run; ``offers`` are those of all runs since the last full one."""
        if name == "offers":
            return tables.read_offers(self.spark, f"{self.base}/offers", self.offer_runs)
        return self.spark.read.parquet(self._path(name))

    def export(self, folder: str) -> None:
        """The last run's report and cleaned offers as CSV folders under ``folder``."""
        files.write_report(self.read("report"), f"{folder}/report")
        files.write_volume_offers(self.read("volume_offers"), f"{folder}/volume_offers")
        files.write_unit_offers(self.read("unit_offers"), f"{folder}/unit_offers")

    def _collect_offers(self, catalog: DataFrame, landed: Landed, now) -> None:
        """Search plan and page offers of the wanted products, added to the offer table.

        A page is parsed once, where it lies; what was found in it is written, and only
        that is joined with the instructions that search for it.
        """
        instructions = self._stage(
            searchplan.instruction_list(catalog, landed.modifiers, "seq"), "instructions"
        )
        plan = self._stage(searchplan.search_plan(instructions), "search_plan")
        search = ["site", "search_keyword", "search_mode"]
        parsed = self._stage(extract.raw_fields(landed.pages, sites.PAGE_FIELDS), "parsed_pages")
        searches = self._stage(plan.select(*search).distinct(), "searches")
        raw = lookup_join(parsed, searches, search, "left_semi")
        tables.write_table(
            raw.filter(F.col("error").isNotNull()).select(*search, "url", "error"),
            self._path("failed_pages"),
        )
        described = offers.with_quantity(
            offers.page_facts(raw.filter(F.col("error").isNull()))
        )
        accepted = self._stage(
            offers.relevant_offers(offers.valid_offers(described)), "page_offers"
        )
        planned = lookup_join(accepted, plan, search)
        capped = offers.capped_offers(planned, ["position", "product"])
        rows = offers.assembled_offers(capped, instructions, F.lit(now.date()))
        tables.write_offers(rows, f"{self.base}/offers", self.run_id)

    def _clean(self, manual: DataFrame) -> tuple[DataFrame, DataFrame]:
        cleaned = self._stage(clean.clean_offers(self.read("offers"), manual), "clean_offers")
        return (
            self._stage(clean.volume_offers(cleaned), "volume_offers"),
            self._stage(clean.unit_offers(cleaned), "unit_offers"),
        )

    def _train(self, volume, units, quotes, products) -> None:
        own = training.own_quotes(quotes, products, self.settings.company)
        train_volume = self._stage(
            training.volume_training(market.trim_outliers(volume, "price_per_liter"), own),
            "train_volume",
        )
        train_units = self._stage(
            training.unit_training(market.trim_outliers(units, "price_per_item"), own),
            "train_units",
        )
        for frame, size, label, name in (
            (train_volume, "volume_liters", "price_per_liter", "volume"),
            (train_units, "total_quantity", "price_per_item", "units"),
        ):
            self._stage(market.market_stats(frame, label), f"stats_{name}")
            if not frame.isEmpty():
                model = forest.fit_forest(
                    frame, size, label, self.settings.trees, self.settings.max_depth
                )
                forest.save_model(model, self._path(f"model_{name}"))

    def _predict(self, products: DataFrame, quotes: DataFrame) -> DataFrame:
        ready = self._stage(
            pricing.prediction_frame(
                products, pricing.latest_quotes(quotes), self.settings.company
            ).withColumn(
                "path",
                pricing.price_path(F.col("volume_liters"), F.col("pack_quantity_units")),
            ),
            "to_predict",
        )
        by_path = {p: ready.filter(F.col("path") == p).drop("path") for p in
                   ("volume", "unit", "none")}
        parts = [by_path["none"].withColumns({
            "predicted_price_per_unit": F.lit(0.0), "model_confidence": F.lit(0.0),
        })]
        if not by_path["volume"].isEmpty():
            parts.append(
                forest.predict(by_path["volume"], self._path("model_volume"), "volume_liters")
            )
        if not by_path["unit"].isEmpty():
            sized = by_path["unit"].withColumn("total_quantity", F.col("pack_quantity_units"))
            parts.append(
                forest.predict(sized, self._path("model_units"), "total_quantity")
                .drop("total_quantity")
            )
        predicted = parts[0]
        for part in parts[1:]:
            predicted = predicted.unionByName(part)
        stats = pricing.both_stats(self.read("stats_volume"), self.read("stats_units"))
        return self._stage(pricing.price_report(predicted, stats), "report")

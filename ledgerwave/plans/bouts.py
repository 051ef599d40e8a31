"""The bout analytics, composed from the five bout tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerwave.operators import careers, pairs
from ledgerwave.session import fresh_path
from ledgerwave.sources import sample
from ledgerwave.sources.layers import materialize_layer

# "Whole career": later than any bout.
END_OF_CAREER = "2099-01-01"


def in_place(table: DataFrame) -> DataFrame:
    return table


@dataclass
class Bouts:
    """Every table of the bout analytics as a lazy DataFrame.

    ``kept`` may write a table that several steps of one query read, so that it is made once.
    """

    table: Callable[[str], DataFrame]
    kept: Callable[[DataFrame], DataFrame] = in_place

    @cached_property
    def fight_details(self) -> DataFrame:
        return self.table("fight_details")

    @cached_property
    def fights(self) -> DataFrame:
        return self.table("fights")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def round_stats(self) -> DataFrame:
        return self.table("round_stats")

    @cached_property
    def fighters(self) -> DataFrame:
        return self.table("fighters")

    @cached_property
    def names(self) -> DataFrame:
        return pairs.entity_names(self.fight_details)

    @cached_property
    def totals(self) -> DataFrame:
        return pairs.per_side_totals(self.round_stats)

    @cached_property
    def paired(self) -> DataFrame:
        return pairs.pair_opponents(self.totals)

    @cached_property
    def flagged(self) -> DataFrame:
        return pairs.loss_flag(self.paired, self.fight_details)

    @cached_property
    def raw_index(self) -> DataFrame:
        return pairs.chin_index(self.flagged, self.names)

    @cached_property
    def index(self) -> DataFrame:
        return pairs.disambiguate_names(self.raw_index)

    @cached_property
    def ages(self) -> DataFrame:
        return pairs.age_at_event(self.totals, self.fights, self.events, self.fighters)

    @cached_property
    def clean(self) -> DataFrame:
        return self.kept(careers.bouts_clean(self.fight_details, self.fights, self.events))

    @cached_property
    def stats(self) -> DataFrame:
        return careers.side_stats(self.round_stats)

    @cached_property
    def sides(self) -> DataFrame:
        return self.kept(careers.bout_sides(self.clean, self.stats))

    @cached_property
    def results(self) -> DataFrame:
        return careers.outcomes(self.clean)

    @cached_property
    def state(self) -> DataFrame:
        return careers.career_state(self.sides, results=self.results)

    @cached_property
    def profiles(self) -> DataFrame:
        return careers.profiles(self.state)

    @cached_property
    def final_profiles(self) -> DataFrame:
        return careers.profiles(careers.career_state(self.sides, END_OF_CAREER, self.results))

    @cached_property
    def training(self) -> DataFrame:
        # Written once more, so that what made the profiles is freed before they are shuffled to the bouts.
        return careers.training_pairs(self.clean, self.kept(self.profiles))


def sample_bouts(spark: SparkSession, folder: str, write: bool = False) -> Bouts:
    """The bout analytics over the sample tables; with ``write``, bouts and sides are written once and read from there."""
    tables = sample.Tables(spark, folder)

    def kept(table: DataFrame) -> DataFrame:
        return materialize_layer(spark, "careers", {"table": table}, fresh_path(spark, "bouts"))["table"]

    return Bouts(lambda name: sample.load(tables, name), kept if write else in_place)

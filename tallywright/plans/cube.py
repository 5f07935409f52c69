"""All measures for any selection of labels, from cells that are stored once.

A cell is one combination of labels of the slicers. Counts, sums and extremes add up over cells; employers, cities,
weeks and tags are bitmaps and count exactly for any union of cells; employers and tags keep their counts per cell, and
pay rows keep their cell. So a report page reads the facts once, whatever is selected on it afterwards.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.text import safe_ratio, to_lakh
from tallywright.operators.bitmaps import bitmaps, merged
from tallywright.operators.quantiles import group_stats
from tallywright.operators.sets import apply_filters, has_tag
from tallywright.plans.demand import known_employer, specific_city
from tallywright.plans.kpi import READ, VALUE, conditions, derived, glue
from tallywright.session import materialize

#: Distinct things and the measure that counts each.
THINGS = {"company": "unique_companies", "city": "unique_specific_cities", "week": "complete_weeks", "skill": "unique_skills"}
#: Bits of the slicers that a row is over all labels of, the first slicer the highest.
LEVEL = "rolled_up"


@dataclass(frozen=True)
class Cells:
    """Stored tables, each with the columns ``slicers``."""

    slicers: tuple[str, ...]
    counts: DataFrame  #: one row per cell
    employers: DataFrame  #: (company_name, n) of known employers
    things: DataFrame  #: (thing, bucket, bits)
    links: DataFrame  #: (n) links to tags
    pay: DataFrame  #: (has_tag, value) of the jobs with pay


def store_cells(jobs: DataFrame, bridge: DataFrame, slicers: Sequence[str], tag: str = fixed.COMPARED_TAG) -> Cells:
    """Count and store the cells of ``slicers``, columns of ``jobs`` with few labels each (a null is a label).

    The facts are read once and written with the short columns that measures read; every table of the cells comes from
    these. All but the pay rows are bounded by cells times employers, cities, weeks or tags.
    """
    slicers = tuple(slicers)
    kept = materialize(jobs.select(*dict.fromkeys([*READ, *slicers])), name="kept")
    eligible = F.col("salary_analysis_eligible")
    value = F.when(eligible, F.col(VALUE))
    counts = kept.groupBy(*slicers).agg(
        F.count(F.lit(1)).alias("analytical_vacancies"), *[F.count_if(x).alias(name) for name, x in conditions().items()],
        F.sum(value).alias("_sum"), F.count(value).alias("_values"), F.min(value).alias("_min"), F.max(value).alias("_max"),
    )
    employers = materialize(kept.where(known_employer()).groupBy(*slicers, "company_name").agg(F.count(F.lit(1)).alias("n")), name="employers")
    tags = materialize(
        bridge.join(kept.select("job_id", *slicers), "job_id").groupBy(*slicers, "skill").agg(F.count(F.lit(1)).alias("n")), name="tags")
    named = lambda rows, thing, name: rows.select(*slicers, F.lit(thing).alias("thing"), name.cast("string").alias("name"))
    things = (
        named(employers, "company", F.col("company_name")).unionByName(named(tags, "skill", F.col("skill")))
        .unionByName(named(kept.where(specific_city()), "city", F.col("city")))
        .unionByName(named(kept.where("is_complete_week"), "week", F.col("week_start")))
    )
    pay = has_tag(kept.where(eligible).select("job_id", VALUE, *slicers), bridge, tag).drop("job_id")
    return Cells(
        slicers, materialize(counts, name="cells"), employers, materialize(bitmaps(things, [*slicers, "thing"], ["thing", "name"]), name="things"),
        tags.groupBy(*slicers).agg(F.sum("n").alias("n")), materialize(pay, name="pay"),
    )


def all_sets(slicers: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the slicers."""
    return [s for k in range(len(slicers) + 1) for s in itertools.combinations(slicers, k)]


def _level(slicers: Sequence[str], kept: Sequence[str]) -> int:
    return sum((s not in kept) << (len(slicers) - 1 - i) for i, s in enumerate(slicers))


def measures(cells: Cells, filters: Sequence[Column] = (), sets: Sequence[Sequence[str]] = ((),)) -> DataFrame:
    """The measures of ``kpis`` for the cells that pass ``filters``, per group of each of ``sets`` of slicers.

    ``filters`` are conditions on slicers: any labels of any of them. A row is told by ``rolled_up`` and its labels; the
    slicers outside its set are null there. The sets are grouped in one pass over each stored table (grouping sets), the
    quantiles of all sets, with and without the tag, in one sketch and one pass over the bands. A group without jobs has
    no row. As in ``kpis``, the comparison with and without a tag reads the tags of all jobs.
    """
    slicers, keys = cells.slicers, [LEVEL, *cells.slicers]

    def rolled(df: DataFrame, *aggs: Column, also: Sequence[str] = ()) -> DataFrame:
        level = F.shiftright(F.grouping_id(), len(also)).cast("bigint").alias(LEVEL)
        groups = apply_filters(df, filters).groupingSets([[*s, *also] for s in sets], *slicers, *also)
        return groups.agg(level, *aggs)

    out = rolled(
        cells.counts, *[F.sum(c).alias(c) for c in ("analytical_vacancies", *conditions())],
        to_lakh(safe_ratio(F.sum("_sum"), F.sum("_values"))).alias("mean_salary_lakh"),
        to_lakh(F.min("_min")).alias("minimum_salary_lakh"), to_lakh(F.max("_max")).alias("maximum_salary_lakh"),
    )
    buckets = rolled(cells.things, merged().alias("n"), also=("thing", "bucket"))
    named = [F.coalesce(F.sum(F.when(F.col("thing") == thing, F.col("n"))), F.lit(0)).cast("bigint").alias(c) for thing, c in THINGS.items()]
    out = glue(out, buckets.groupBy(*keys).agg(*named), keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "company_name"))
    top = rolled(cells.employers, F.sum("n").alias("n"), also=("company_name",)).withColumn("_p", place).where(F.col("_p") <= 5)
    out = glue(out, top.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("top_5_employer_jobs")), keys)
    out = glue(out, rolled(cells.links, F.sum("n").cast("bigint").alias("job_skill_rows")), keys)
    out = glue(out, _pay_quantiles(cells, filters, sets), keys)
    zeros = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in (*THINGS.values(), "job_skill_rows", "tag_salary_observations")}
    return derived(out.withColumns(zeros))


def _pay_quantiles(cells: Cells, filters: Sequence[Column], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Quartiles per group of each set, and medians and counts with and without the tag.

    A pay row stands once for every set and side that it belongs to; the copies meet in partial aggregates at once.
    """
    slicers, keys = cells.slicers, [LEVEL, *cells.slicers]
    types = dict(cells.pay.dtypes)
    label = lambda s, kept: F.col(s) if s in kept else F.lit(None).cast(types[s])
    groups = [
        F.struct(F.lit(_level(slicers, kept)).cast("bigint").alias(LEVEL), *[label(s, kept).alias(s) for s in slicers], side.alias("side"))
        for kept in sets for side in (F.lit("all"), F.when(F.col("has_tag"), "with").otherwise("without"))
    ]
    rows = apply_filters(cells.pay, filters).select(VALUE, F.explode(F.array(*groups)).alias("_g")).select(VALUE, "_g.*")
    found = group_stats(rows, [*keys, "side"], VALUE, (0.25, 0.5, 0.75), ("_25", "_50", "_75"), n="_n")
    of = lambda side, column, name: F.max(F.when(F.col("side") == side, F.col(column))).alias(name)
    return found.groupBy(*keys).agg(
        *[of("all", f"_{p}", f"_p{p}") for p in (25, 50, 75)], of("with", "_n", "tag_salary_observations"),
        of("with", "_50", "_with"), of("without", "_50", "_without"),
    )

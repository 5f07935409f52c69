"""Raw postings to the clean table and the entity-tag bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed, labels
from tallywright.functions.calendar import in_window, month_key, recent_flag, week_start, with_complete_week
from tallywright.functions.extract import extract_range, extract_tags
from tallywright.functions.patterns import map_sql, quoted, search_text
from tallywright.functions.pay import amounts_in_text, evidence, normalize_found, salary_flags
from tallywright.functions.text import clean_text, is_placeholder, odd_bool, parse_bool, source_family, source_provider, to_number
from tallywright.operators.names import canonicalize
from tallywright.operators.quality import expect, expect_count, expect_unique, union_reports


def utc_timestamp(c: Column) -> Column:
    """Timestamp of a text, shifted so that its calendar parts are those of UTC in any session zone."""
    return F.to_utc_timestamp(F.try_to_timestamp(c), F.current_timezone())


def raw_report(raw: DataFrame, expected_rows: int | None = None, start=fixed.WINDOW_START, end=fixed.WINDOW_END) -> DataFrame:
    """Gates on raw postings: pinned row count, repeated ids, dates outside the window."""
    reports = [
        expect_unique(raw, ["job_id"], "repeated_job_ids"),
        expect(raw, {"outside_date_window": ~in_window(utc_timestamp(F.col("created")), start, end)}),
    ]
    if expected_rows is not None:
        reports.append(expect_count(raw, expected_rows, "row_count_difference"))
    return union_reports(*reports)


def drop_placeholders(df: DataFrame, col: str = "company_name", names=fixed.PLACEHOLDER_NAMES) -> DataFrame:
    return df.where(~is_placeholder(F.col(col), names))


def clean_jobs(
    raw: DataFrame, end: str = fixed.WINDOW_END, tag_rules=fixed.TAG_RULES, role_rules=fixed.ROLE_RULES
) -> DataFrame:
    """One row per kept posting: the fixed clean columns plus ``tags`` (sorted array).

    Three steps leave the row-wise flow: employer spellings are counted by name, the
    span of dates is one aggregate, and renamed spellings are joined back. Everything else
    is projection, so columns that are not selected later cost nothing. The join is the last step: the rules
    run on the rows as they are dealt, not on those that a join has gathered by name (one name may have very many).
    """
    for column in ("salary_min", "salary_max", "salary_is_predicted", "contract_type", "contract_time", "redirect_url"):
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(None).cast("string"))
    kept = drop_placeholders(raw)
    # Texts are normalized once, as columns of their own, before the rules read them.
    df = kept.withColumns({
        "_role_text": search_text(F.col("title")),
        "_about": clean_text(F.col("description")),
        "_where": clean_text(F.col("location_name")),
    })
    df = df.withColumns({
        "_about_text": search_text(F.col("_about"), cleaned=True),
        "_place_text": search_text(F.col("_where"), cleaned=True),
    })
    df = df.withColumn("_text", F.concat_ws(" ", "_role_text", "_about_text"))
    # The long rules stand in the projections of the ranges and the tags. Those hold higher-order functions, so Spark
    # makes their code in short methods; fused with the other steps it is one method of over 8,000 bytes, and those the
    # JVM only interprets.
    low, high = to_number(F.col("salary_min")), to_number(F.col("salary_max"))
    usable = salary_flags(low, high, F.col("salary_is_predicted"))[1]
    df = df.withColumns({
        "_range": extract_range("_text"),
        "city": labels.normalize_place("_place_text", "_where"),
        "role_family": labels.classify("_role_text", role_rules),
        "_mode_text": F.concat_ws(" ", "_text", "_place_text"),
        "created_at": utc_timestamp(F.col("created")),
        "_source": clean_text(F.col("source")),
        "salary_min_source": low,
        "salary_max_source": high,
        "_usable": usable,
        **amounts_in_text("_about", "_about_text", usable),
    })
    df = df.withColumns({
        "tags": extract_tags("_text", tag_rules),
        "posted_date": F.to_date("created_at"),
        "source_family": source_family(F.col("_source"), cleaned=True),
        "source_provider": source_provider(F.col("_source"), cleaned=True),
        "work_mode": labels.work_mode("_mode_text"),
        "state": labels.normalize_region("city", "_place_text"),
        "location_scope": labels.place_scope("city"),
        "experience_min_years": F.col("_range.min"),
        "experience_max_years": F.col("_range.max"),
        **evidence("_about"),
    })
    df = df.withColumns({
        "experience_band": labels.band("experience_min_years"),
        "skill_count": F.size("tags"),
        "has_extracted_skill": F.size("tags") > 0,
        "posted_month": month_key(F.col("posted_date")),
        "week_start": week_start(F.col("posted_date")),
        "is_recent_90d": recent_flag(F.col("posted_date"), end),
    })
    df = normalize_found(df)
    # The span needs only the date of the kept rows, so it is read from the raw columns.
    span = kept.select(F.to_date(utc_timestamp(F.col("created"))).alias("posted_date"))
    df = canonicalize(with_complete_week(df, "posted_date", span=span), "company_name", counted=kept)
    return df.select(*fixed.CLEAN_COLUMNS, "tags")


def explode_tags(
    df: DataFrame, entity: str = "job_id", tags: str = "tags", categories=fixed.TAG_CATEGORIES,
    default: str = fixed.OTHER_CATEGORY,
) -> DataFrame:
    """(id, tag, category). Ids are unique and tag arrays distinct, so the rows are too.

    The outer form keeps the planner from adding a filter on the array, which would be
    pushed below the projection and run the whole extraction a second time.
    """
    rows = df.select(entity, F.explode_outer(tags).alias("skill")).where(F.col("skill").isNotNull())
    category = f"coalesce(try_element_at({map_sql(categories)}, skill), {quoted(default)})"
    return rows.withColumn("skill_category", F.expr(category))


def bridge_of(jobs: DataFrame) -> DataFrame:
    return explode_tags(jobs, "job_id", "tags")


def clean_rules() -> dict[str, Column]:
    """Conditions that a bad row of the clean table meets."""
    band, years, eligible = F.col("experience_band"), F.col("experience_min_years"), F.col("salary_analysis_eligible")
    low, high, mid = F.col("salary_min"), F.col("salary_max"), F.col("salary_midpoint")
    return {
        "placeholder_names": is_placeholder(F.col("company_name")),
        "band_without_years": years.isNull() != (band == fixed.NOT_SPECIFIED),
        "top_band_too_low": (band == fixed.BAND_ABOVE) & (years < 15),
        "city_is_country": F.col("city") == "India",
        "country_scope": (F.col("city") == fixed.CITY_NOT_SPECIFIED) & (F.col("location_scope") != fixed.SCOPE_COUNTRY),
        "eligible_pay_missing": eligible & (low.isNull() | high.isNull() | mid.isNull()),
        "eligible_pay_not_positive": eligible & ((low <= 0) | (high <= 0)),
        "eligible_pay_unordered": eligible & (high < low),
        "eligible_pay_midpoint": eligible & (F.abs(mid - (low + high) / 2) > 0.01),
        "eligible_but_predicted": eligible & parse_bool(F.col("salary_is_predicted")),
        "unexpected_boolean_text": odd_bool(F.col("salary_is_predicted")),
        "week_not_monday": F.col("is_complete_week") & (F.weekday("week_start") != 0),
        "years_range": (years < 0) | (F.col("experience_max_years") < years),
        "negative_skill_count": F.col("skill_count") < 0,
    }

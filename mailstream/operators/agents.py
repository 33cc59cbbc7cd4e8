"""User-agent parsing on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.functions import agents as ua
from mailstream.functions.agents import BROWSERS, FIELDS, SYSTEMS, Rule


def parse_user_agent(
    rows: DataFrame,
    agent: str = "http_user_agent",
    browsers: Sequence[Rule] = BROWSERS,
    systems: Sequence[Rule] = SYSTEMS,
) -> DataFrame:
    """Add the struct `user_agent` with the nine fields; no shuffle.

    Each step projects columns that later steps refer to more than once, so each
    is evaluated once per row.
    """
    tables = {"browser": browsers, "os": systems}
    text, words, model = F.col("__text"), F.col("__words"), F.col("__model")
    browser, system, device = F.col("__browser"), F.col("__os"), F.col("__device")
    cut = rows.withColumn("__text", ua.unescape_commas(agent))
    keyed = cut.withColumn("__words", ua.text_words(text)).withColumns(
        {f"__{name}": ua.rule_key(words, rules) for name, rules in tables.items()}
    )
    ruled = keyed.withColumns(
        {
            f"__{name}": ua.rule_struct(F.col(f"__{name}"), rules)
            for name, rules in tables.items()
        }
    )
    # Only Android texts name a model after the system version.
    on_android = F.when(system["kind"] == "android", ua.android_model(text))
    modelled = ruled.withColumn("__model", F.coalesce(on_android, F.lit("")))
    named = modelled.withColumns(
        {
            "__browser_version": ua.version(browser, text),
            "__os_version": ua.version(system, text),
            "__device": ua.device(text, browser, system, model),
        }
    )
    final = named.withColumns(
        {
            f"__{name}_version": ua.version_name(
                F.col(f"__{name}"), F.col(f"__{name}_version")
            )
            for name in tables
        }
    )
    fields = {
        "browser_family": browser["family"],
        "browser_version": F.col("__browser_version"),
        "os_family": system["family"],
        "os_version": F.col("__os_version"),
        "device_family": device["family"],
        "device_brand": device["brand"],
        "device_model": device["model"],
        "device_type": ua.device_type(text, browser, system, model),
        "device_touch_capable": ua.touch_flag(
            ua.is_touch(text, system, F.col("__os_version"))
        ),
    }
    struct = F.struct(*(fields[name].alias(name) for name in FIELDS))
    return final.select(*rows.columns, struct.alias("user_agent"))


def struct_expand(rows: DataFrame, struct: str = "user_agent") -> DataFrame:
    """Replace a struct column by its fields."""
    others = [name for name in rows.columns if name != struct]
    return rows.select(*others, f"{struct}.*")

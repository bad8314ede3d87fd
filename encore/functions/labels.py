"""Text names of boards, made only where rows leave for a key-value store."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name pieces of the published board keys.
ROLE_NAMES = {"host": "anc", "user": "usr"}
PERIOD_NAMES = {"all": "", "day": "Dy", "week": "Wk", "month": "Mth"}
CLASS_NAMES = {"all": "Al", "special": "Spec"}


def _pick(column: str, names: dict[str, str]) -> Column:
    out = F.lit("")
    for value, name in names.items():
        out = F.when(F.col(column) == value, name).otherwise(out)
    return out


def _suffix() -> Column:
    """Period key as published: the week board carries only its week number."""
    week = F.regexp_extract("period_key", r"-W0?(\d+)$", 1)
    return F.when(F.col("period") == "week", week).otherwise(F.col("period_key"))


def gift_board_label() -> Column:
    """``ancDyAlGf20181010``, ``usrGrp3MthSpecGf201810``, ``u2q77_WkAlGf41`` and so on."""
    family = F.concat(_pick("period", PERIOD_NAMES), _pick("gift_class", CLASS_NAMES), F.lit("Gf"), _suffix())
    group = F.when(F.col("scope") == "group", F.concat(F.lit("Grp"), F.col("grp"))).otherwise("")
    ranked = F.concat(_pick("role", ROLE_NAMES), group, family)
    donors = F.concat(F.lit("u2q"), F.col("owner"), F.lit("_"), family)
    return F.when(F.col("role") == "donor", donors).otherwise(ranked)


def popularity_board_label() -> Column:
    return F.concat(F.lit("anc"), _pick("period", PERIOD_NAMES), F.lit("Pop"), _suffix())


def top_donor_label() -> Column:
    """Name of the map of best donors: the donor family without host."""
    return F.concat(F.lit("u2q"), _pick("period", PERIOD_NAMES), _pick("gift_class", CLASS_NAMES), F.lit("Gf"), _suffix())


def board_key(namespace: str, label: Column, kind: str = "rank") -> Column:
    """``namespace:project[:signUp]:label:rank``."""
    signed = F.when(F.col("scope") == "signUp", F.lit("signUp"))
    return F.concat_ws(":", F.lit(namespace), F.col("project"), signed, label, F.lit(kind))


def split_board_key(key: Column) -> Column:
    """(namespace, project, scope, label, kind) of a board key; null unless it has 4 or 5 parts."""
    parts = F.split(key, ":")
    signed = F.size(parts) == 5
    return F.when(
        F.size(parts).isin(4, 5),
        F.struct(
            parts[0].alias("namespace"),
            parts[1].alias("project"),
            F.when(signed, F.get(parts, F.lit(2))).otherwise("all").alias("scope"),
            F.get(parts, F.size(parts) - 2).alias("label"),
            F.get(parts, F.size(parts) - 1).alias("kind"),
        ),
    )

"""Service levels of runs, and who is told about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.functions.calendar import clock_seconds


def sla_flag(run_log: DataFrame, phases: DataFrame) -> DataFrame:
    """Traffic light of every run: its elapsed time against the limits of its phase, or the error mark.

    Elapsed time is exact, including fractions of a second; a limit that is met to the second is still within it.
    Failed runs need no limits. Other runs of a phase without limits stay, with the mark of an unknown phase.
    """
    limits = phases.select(
        "phase_id", clock_seconds(F.col("green")).alias("_green"), clock_seconds(F.col("yellow")).alias("_yellow")
    )
    elapsed = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / F.lit(1_000_000)
    flag = (
        F.when(F.col("failed"), codes.FAILED)
        .when(F.col("_green").isNull() | F.col("_yellow").isNull(), codes.UNKNOWN_PHASE)
        .when(elapsed <= F.col("_green"), codes.GREEN)
        .when(elapsed <= F.col("_yellow"), codes.YELLOW)
        .otherwise(codes.RED)
    )
    return run_log.join(limits, "phase_id", "left").withColumn("flag", flag).drop("_green", "_yellow")


def area_recipients(
    areas: DataFrame, area_roles: DataFrame, roles: DataFrame, role_menus: DataFrame, role_users: DataFrame,
    menu_functions: DataFrame, menu_id: int = codes.NOTICE_MENU,
) -> DataFrame:
    """Users of each area whose role reaches the given menu, each once."""
    menus = menu_functions.filter(F.col("menu_id") == menu_id).select(F.col("function_id").alias("role_menu_id"))
    entitled = (
        role_menus.select("role_id", "role_menu_id")
        .join(menus, "role_menu_id", "left_semi")
        .join(roles.select("role_id"), "role_id", "left_semi")
        .select("role_id")
        .distinct()
    )
    return (
        area_roles.join(areas.select("area_id"), "area_id", "left_semi")
        .join(entitled, "role_id", "left_semi")
        .join(role_users.select("role_id", "user_id"), "role_id")
        .select("area_id", "user_id")
        .distinct()
    )


def notification_fanout(notices: DataFrame, recipients: DataFrame) -> DataFrame:
    """One row per notice and recipient of its area."""
    return notices.join(recipients, "area_id")


def notices_without_recipients(notices: DataFrame, recipients: DataFrame) -> DataFrame:
    """Notices that would reach nobody because their area has no entitled user."""
    return notices.join(recipients.select("area_id"), "area_id", "left_anti")

"""Customer segments by lifetime spend."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Thresholds(NamedTuple):
    """Lowest spend, in whole currency units, of the upper three segments."""

    platinum: int = 2500
    gold: int = 1000
    silver: int = 300


# Segment labels as reports show them, short and with their limits.
def segment_names(limits: Thresholds) -> tuple[str, str, str, str]:
    return ("VIP Platinum", "Gold Tier", "Silver Tier", "Bronze Member")


def segment_captions(limits: Thresholds) -> tuple[str, str, str, str]:
    platinum, gold, silver = (f"${limit:,}" for limit in limits)
    return (
        f"VIP Platinum (Spent > {platinum})",
        f"Gold Tier ({gold} - {platinum})",
        f"Silver Tier ({silver} - {gold})",
        f"Bronze Member (< {silver})",
    )


def segment(spent: Column, limits: Thresholds, labels: tuple[str, str, str, str]) -> Column:
    """Label of a total; a missing total falls to the lowest segment."""
    return (
        F.when(spent >= limits.platinum, labels[0])
        .when(spent >= limits.gold, labels[1])
        .when(spent >= limits.silver, labels[2])
        .otherwise(labels[3])
    )

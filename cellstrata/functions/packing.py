"""Packed composition words, waveform noise thresholds and hashes."""

from __future__ import annotations

import hashlib
import json
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

LANES = 8


def _lane(count: Column, total: Column) -> Column:
    """255 * share, rounded half to even, at least 1 where there is any."""
    byte = F.least(F.rint(255 * count / total), F.lit(255.0)).cast("long")
    return F.when(count > 0, F.greatest(byte, F.lit(1))).otherwise(F.lit(0))


def pack(lanes: list[Column]) -> Column:
    word = F.lit(0).cast("long")
    for i, lane in enumerate(lanes):
        word = word.bitwiseOR(F.shiftleft(lane.cast("long"), 8 * i))
    return word


def unpack(word) -> list[Column]:
    word = F.col(word) if isinstance(word, str) else word
    return [F.shiftrightunsigned(word, 8 * i).bitwiseAND(F.lit(255)) for i in range(LANES)]


def composition(surfaces: list[Column], threshold: int = 2) -> list[Column]:
    """Aggregates word and n of confidence columns, five of them: lanes 0 to 4 are the surfaces at or above the threshold, 5 to 7 rows whose strongest is exactly 2, 3, 4; n is the rows with any."""
    strongest = F.greatest(*surfaces)
    signal = strongest >= threshold
    n = F.sum(F.when(signal, 1).otherwise(0))
    counts = [F.sum(F.when(signal & (s >= threshold), 1).otherwise(0)) for s in surfaces]
    counts += [F.sum(F.when(signal & (strongest == level), 1).otherwise(0)) for level in (2, 3, 4)]
    lanes = [_lane(c, n) for c in counts]
    return [F.when(n > 0, pack(lanes)).otherwise(F.lit(0)).cast("long").alias("word"), n.cast("long").alias("n")]


def merge_compositions(word, n) -> list[Column]:
    """Aggregates word and n of packed words: lanes averaged by n."""
    n = F.col(n)
    total = F.sum(n)
    lanes = []
    for lane in unpack(word):
        part = F.sum(lane * n)
        byte = F.least(F.rint(part / total), F.lit(255.0)).cast("long")
        lanes.append(F.when(part > 0, F.greatest(byte, F.lit(1))).otherwise(F.lit(0)))
    return [F.when(total > 0, pack(lanes)).otherwise(F.lit(0)).cast("long").alias("word"), total.alias("n")]


def lane_counts(word, n) -> list[Column]:
    """Counts that lanes stand for; exact up to 254 rows."""
    return [F.rint(lane * F.col(n) / 255.0).cast("long") for lane in unpack(word)]


def noise_sigmas(samples: float, correlation: float = 1.0, false_alarm: float = 0.01) -> float:
    """Standard deviations above the mean that noise passes with a given chance in a whole waveform (Sidak's split over independent samples)."""
    independent = max(samples / correlation, 1.0)
    return NormalDist().inv_cdf((1 - false_alarm) ** (1 / independent))


def flux(count, mean, sigma, n_sigma: float, gain: float = 1.0) -> Column:
    """Weight of a waveform sample above noise, else 0."""
    count, mean, sigma = (F.col(x) if isinstance(x, str) else x for x in (count, mean, sigma))
    return F.when(count > mean + n_sigma * sigma, (count - mean) * gain).otherwise(F.lit(0.0))


def canonical(value) -> str:
    """JSON with sorted keys and no blanks; numbers that JSON can't carry are refused."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)


def digest_of(value) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def combined_hash(hashes: Column) -> Column:
    """Aggregate: one hash of a group's hex hashes, whatever their order."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(hashes)), "\n"), 256)


def ids_hash(ids: Column) -> Column:
    """Aggregate: hash of a group's distinct ids."""
    return F.sha2(F.array_join(F.sort_array(F.collect_set(ids.cast("string"))), "\n"), 256)

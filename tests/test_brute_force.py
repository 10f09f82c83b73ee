"""The whole chain against plain Python on random small inputs."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest

from envhealth import operators as op
from envhealth import schemas

RUN = dt.date(2024, 6, 1)


def raw_readings(rng):
    for _ in range(400):
        day = dt.date(1999, 1, 1) + dt.timedelta(days=rng.randrange(0, 9500, 61))
        text = rng.choice([f"{day} 10:00:00", f"\t{day}\n", f"{day}T01:02", "n/a", None, f"x{day}"])
        value = rng.choice([rng.uniform(-50, 1100), 0.0, 1000.0, None])
        yield text, "city", None if value is None else repr(round(value, 3))


def raw_indicators(rng):
    for i in range(200):
        year = rng.choice([str(rng.randrange(1996, 2030)), "2010.0", "abc", None])
        rate = rng.choice([f"{rng.uniform(0, 99):.1f}", "7.", " 8", "9%", "12\n", None])
        yield year, rate, f"c{i}", "d", rng.choice(["\ta", "b ", "c\nd"]), "o"


def clean(text):
    return re.sub("[\r\n\t]", " ", text).strip(" ")


def expected(readings, indicators):
    days: dict[dt.date, list[float]] = {}
    for text, _, value in readings:
        found = re.match(r"\d{4}-\d{2}-\d{2}(?=$|[ T])", clean(text)) if text else None
        if found and value is not None and 0 <= float(value) <= 1000:
            days.setdefault(dt.date.fromisoformat(found[0]), []).append(float(value))
    years: dict[int, list[tuple[float, int]]] = {}
    for day, values in days.items():
        years.setdefault(day.year, []).append((sum(values) / len(values), len(values)))
    rows = []
    for year, rate, confidence, _, group, outcome in indicators:
        whole = re.fullmatch(r"(\d+)(\.\d*)?", year or "")
        if not whole or not re.fullmatch(r"[0-9]+\.?[0-9]*\n?", rate or ""):
            continue
        year = int(whole[1])
        if 2000 <= year <= 2025 and year in years:
            means = [m for m, _ in years[year]]
            rows.append((year, sum(means) / len(means), min(means), max(means), len(means),
                         sum(n for _, n in years[year]) / len(means),
                         clean(rate), clean(group), outcome, confidence))
    return sorted(rows, key=lambda r: (r[0], r[-1]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_combined_rows(spark, seed):
    rng = random.Random(seed)
    readings, indicators = list(raw_readings(rng)), list(raw_indicators(rng))
    extracted = spark.createDataFrame(readings, "utc_datetime string, city string, pm25_raw string")
    columns = "year string, percentage string, confidence_interval string, description string, group string, outcome_or_indicator string"
    raw = spark.createDataFrame(indicators, columns)
    daily = op.daily_stats(op.clean_readings(extracted))
    found = op.combine(daily, op.clean_indicators(raw), RUN)
    assert found.columns == schemas.COMBINED.names
    rows = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[-1]))
    wanted = expected(readings, indicators)
    assert len(rows) == len(wanted) > 0
    for row, want in zip(rows, wanted):
        mean = float(Decimal(repr(want[1])).quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert row[1] == pytest.approx(mean, abs=0.0101 if abs(want[1] * 100 % 1 - 0.5) < 1e-6 else 1e-9)
        assert row[0] == want[0] and row[2:6] == pytest.approx(want[2:6]) and row[6:] == want[6:]

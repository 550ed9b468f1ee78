"""Made-up hourly readings, messages and their replay as a stream of files."""

from __future__ import annotations

import json
import math
import os
from datetime import datetime, timedelta, timezone
from itertools import count

import numpy as np

JST = timezone(timedelta(hours=9))
HOUR = timedelta(hours=1)
START = datetime(2022, 1, 1, tzinfo=JST)

_mtime = count(1_700_000_000)


def stamp(time: datetime) -> str:
    local = time.astimezone(JST)
    return local.strftime("%Y-%m-%dT%H:%M:%S.") + f"{local.microsecond // 1000:03d}+09:00"


def hourly(days: int = 6, start: datetime = START) -> list[tuple[datetime, float, float]]:
    """(time, temperature, rainfall) per hour, with dry spells of several lengths."""
    rows = []
    for h in range(days * 24):
        temperature = round(8 * math.sin(h / 24 * 2 * math.pi) + h / 50 - 3, 1)
        wet = (h % 17 in (0, 1, 2, 5)) or (40 <= h < 52)
        rows.append((start + h * HOUR, temperature, 0.5 * (1 + h % 3) if wet else 0.0))
    return rows


def message(time: datetime, temperature: float, rainfall: float) -> str:
    return json.dumps(
        {"timestamp": stamp(time), "temperature [°C]": temperature, "rainfall [mm]": rainfall},
        ensure_ascii=False,
    )


def write_messages(folder: str, topic: str, name: str, messages: list[str]) -> None:
    """One more file of the stream, later than all before it."""
    os.makedirs(f"{folder}/{topic}", exist_ok=True)
    path = f"{folder}/{topic}/{name}.txt"
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(messages) + "\n")
    moment = next(_mtime)
    os.utime(path, (moment, moment))


def write_slices(folder: str, topic: str, rows, size: int = 12, first: int = 0) -> None:
    for i in range(0, len(rows), size):
        part = [message(*r) for r in rows[i : i + size]]
        write_messages(folder, topic, f"{first + i:06d}", part)


# --- the same answers in plain Python --------------------------------------------------


def mean(values) -> float:
    """Of 32-bit floats, widened."""
    return float(np.mean(np.array(values, dtype=np.float32).astype(np.float64)))


def daily(rows) -> dict[str, float]:
    days: dict[str, list[float]] = {}
    for time, temperature, _ in rows:
        days.setdefault(time.astimezone(JST).date().isoformat(), []).append(temperature)
    return {day: mean(values) for day, values in days.items()}


def moving(rows) -> dict[str, float]:
    windows: dict[datetime, list[float]] = {}
    for time, temperature, _ in rows:
        hour = time.replace(minute=0, second=0, microsecond=0)
        for k in range(3):
            windows.setdefault(hour - k * HOUR, []).append(temperature)
    return {stamp(start): mean(values) for start, values in windows.items()}


def sessions(times, gap: timedelta = HOUR) -> list[tuple[datetime, datetime, int]]:
    """(first, last + gap, rows) of runs of rows at most ``gap`` apart."""
    runs: list[list[datetime]] = []
    for time in sorted(times):
        if runs and time - runs[-1][-1] <= gap:
            runs[-1].append(time)
        else:
            runs.append([time])
    return [(run[0], run[-1] + gap, len(run)) for run in runs]


def rain_runs(rows) -> list[tuple[str, int]]:
    found = sessions([time for time, _, rain in rows if rain > 0])
    return [(stamp(end), n) for _, end, n in found]

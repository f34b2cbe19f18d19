from __future__ import annotations

import json
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skylog.schemas import AIR_MEASURES, LOCATIONS, WEATHER_MEASURES  # noqa: E402
from skylog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """The session zone has daylight saving on purpose: wall-clock times must not notice."""
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.session.timeZone": "America/Denver",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def hours(start: datetime, count: int) -> list[str]:
    return [(start + timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(count)]


def payload(times: list[str], measures: tuple[str, ...], base: float = 1.0) -> dict:
    """A document as a source delivers it; values vary by hour and stay in range."""
    arrays = {m: [round(base + j + (i % 24) / 10, 2) for i in range(len(times))] for j, m in enumerate(measures)}
    if "weather_code" in arrays:
        arrays["weather_code"] = [i % 4 for i in range(len(times))]
    return {"latitude": 1.0, "hourly_units": {"time": "iso8601"}, "hourly": {"time": times, **arrays}}


def write_payload(folder: Path, name: str, document: dict) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(json.dumps(document, indent=4), encoding="utf-8")
    return path


@pytest.fixture(scope="session")
def full_year(tmp_path_factory) -> tuple[Path, Path]:
    """Payload folders of a whole year for all configured cities, both sources."""
    root = tmp_path_factory.mktemp("landed")
    times = hours(datetime(2025, 1, 1), 8760)
    for i, (city, _, _) in enumerate(LOCATIONS):
        name = f"{city.lower().replace(' ', '_')}_2025-01-01_to_2025-12-31_20260101_060000.json"
        write_payload(root / "weather", name, payload(times, WEATHER_MEASURES, 10 + i))
        write_payload(root / "air", name, payload(times, AIR_MEASURES, 20 + 10 * i))
    return root / "weather", root / "air"

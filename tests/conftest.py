import json
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.plans import Warehouse  # noqa: E402
from starloom.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "starloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SONG_ROWS = [
    # song_id, artist_id, artist_name, title, duration, year, latitude, longitude, location
    ("S1", "A1", "Ann", "Blue", 187.40586, 0, 51.26, -3.94, "QX"),
    ("S2", "A1", "Ann", "Red", 100.5, 1999, 51.26, -3.94, "QX, ZZ"),
    ("S3", "A2", "Bob", "Sun", 60.0, 2001, None, None, ""),
    ("S4", "A2", "Bob", "Sun", 61.9, 2001, None, None, ""),
    ("S3", "A2", "Bob", "Sun", 60.0, 2001, None, None, ""),
]

EVENT_ROWS = [
    # item, artist, song, page, ts, userId, level
    (0, "Ann", "Blue", "NextSong", 1541289599999, "39", "free"),
    (1, "Bob", "Sun", "NextSong", 1541289600000, "39", "free"),
    (2, "Ann", "Nope", "NextSong", 1541289600000, "40", "free"),
    (3, None, "Blue", "NextSong", 1541289600001, "40", "paid"),
    (4, "ann", "Blue", "NextSong", 1541289600001, "40", "free"),
    (5, None, None, "Home", 1541289600002, "39", "paid"),
    (6, None, None, "Home", 1541289600003, "", "free"),
    (7, None, None, None, 1541289600004, "41", "free"),
    (8, "Ann", "Red", "NextSong", 1546214400000, "39", "paid"),
]


def song_record(row):
    song_id, artist_id, artist_name, title, duration, year, latitude, longitude, location = row
    return {
        "num_songs": 1,
        "artist_id": artist_id,
        "artist_latitude": latitude,
        "artist_longitude": longitude,
        "artist_location": location,
        "artist_name": artist_name,
        "song_id": song_id,
        "title": title,
        "duration": duration,
        "year": year,
    }


def event_record(row):
    item, artist, song, page, ts, user_id, level = row
    return {
        "artist": artist,
        "auth": "Known",
        "firstName": "Ida",
        "gender": "F",
        "itemInSession": item,
        "lastName": "Quill",
        "length": None if item == 6 else 301.20467,
        "level": level,
        "location": "Port Ember, ZZ",
        "method": "GET",
        "page": page,
        "registration": None if item == 6 else 1600000123456.0,
        "sessionId": 512,
        "song": song,
        "status": 200,
        "ts": ts,
        "userAgent": '"Agent \\/ {7}" [x]',
        "userId": user_id,
    }


@pytest.fixture(scope="session")
def song_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("song_data")
    for i, row in enumerate(SONG_ROWS):
        folder = root / "A" / ("B" if i % 2 else "C") / "A"
        folder.mkdir(parents=True, exist_ok=True)
        text = json.dumps(song_record(row), indent=4 if i == 0 else None)
        (folder / f"TR{i}.json").write_text(text)
    return str(root)


@pytest.fixture(scope="session")
def log_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("log_data")
    for month in (11, 12):
        folder = root / "2018" / str(month)
        folder.mkdir(parents=True)
        rows = [r for r in EVENT_ROWS if (r[0] == 8) == (month == 12)]
        lines = "\n".join(json.dumps(event_record(r)) for r in rows)
        (folder / f"2018-{month}-04-events.json").write_text(lines + "\n")
    return str(root)


@pytest.fixture
def warehouse(spark, tmp_path):
    """An empty warehouse under schema names of its own."""
    tag = uuid.uuid4().hex[:8]
    return Warehouse(spark, f"staging_{tag}", f"star_{tag}", location=str(tmp_path / "tables"))

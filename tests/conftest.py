import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chatloom.schemas import CHAT
from chatloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def chat(spark):
    """Build chat messages from dicts as they stand in a file."""

    def build(*messages, channel="chan", year=2020, vod_id="1"):
        from pyspark.sql import functions as F

        texts = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
        parsed = texts.select(F.from_json("value", CHAT).alias("m")).select("m.*")
        return parsed.withColumns(
            {"channel": F.lit(channel), "year": F.lit(year), "vod_id": F.lit(vod_id)}
        )

    return build


@pytest.fixture
def land(tmp_path):
    """Write chat files: name to messages, or to raw text."""

    def write(**files):
        raw = tmp_path / "raw"
        raw.mkdir(exist_ok=True)
        for name, content in files.items():
            text = content if isinstance(content, str) else json.dumps(content)
            (raw / f"{name}.json").write_text(text)
        return str(raw)

    return write


def message(emotes=("hi",), badges=None, **changes):
    author = {"id": "1", "name": "ann", "colour": "#ff0000"}
    if badges is not None:
        author["badges"] = [{"name": b, "title": b.title(), "version": i} for i, b in enumerate(badges)]
    author.update(changes.pop("author", {}))
    base = {
        "author": {k: v for k, v in author.items() if v is not None},
        "timestamp": 1_600_000_000_123_456,
        "time_text": "0:10",
        "time_in_seconds": 10.5,
        "message": "hello",
    }
    if emotes is not None:
        base["emotes"] = [{"name": e} for e in emotes]
    return {**base, **changes}


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

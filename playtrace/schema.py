"""Data model: schemas, ordered phases, and the fixed lists that features are built from."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("session_id", T.LongType(), False),
    T.StructField("index", T.IntegerType(), False),
    T.StructField("elapsed_time", T.LongType(), False),
    T.StructField("event_name", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("level", T.IntegerType(), False),
    T.StructField("page", T.DoubleType()),
    T.StructField("room_coor_x", T.DoubleType()),
    T.StructField("room_coor_y", T.DoubleType()),
    T.StructField("screen_coor_x", T.DoubleType()),
    T.StructField("screen_coor_y", T.DoubleType()),
    T.StructField("hover_duration", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("fqid", T.StringType()),
    T.StructField("room_fqid", T.StringType()),
    T.StructField("text_fqid", T.StringType()),
    T.StructField("fullscreen", T.IntegerType()),
    T.StructField("hq", T.IntegerType()),
    T.StructField("music", T.IntegerType()),
    T.StructField("level_group", T.StringType(), False),
])

LABEL_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType(), False),
    T.StructField("correct", T.IntegerType(), False),
])

SESSION = "session_id"
PHASE = "level_group"
#: One feature row is built per session and phase.
KEYS = [SESSION, PHASE]
#: Total order of the events of a session; ``event_id`` breaks ties between repeated indexes.
EVENT_ORDER = ["index", "elapsed_time", "event_id"]
ALL_NULL_COLUMNS = ["fullscreen", "hq", "music"]

# Phases in playing order, and the first question asked in each.
PHASES = ["0-4", "5-12", "13-22"]
FIRST_QUESTION = {"0-4": 1, "5-12": 4, "13-22": 14}
LAST_QUESTION = 18

# Words looked for (case-sensitive substrings) in the text a player saw.
WORDS = [
    "that", "this", "it", "you", "find", "found", "Found", "notebook", "Wells", "wells", "help",
    "need", "Oh", "Ooh", "Jo", "flag", "can", "and", "is", "the", "to",
]

CATEGORY_COLUMNS = ["event_name", "name", "fqid", "room_fqid", "text_fqid", "level", "page"]
VOCAB_COLUMNS = ["event_name", "name", "text", "fqid", "room_fqid", "text_fqid", "page", "level"]
NUNIQUE_COLUMNS = ["event_name", "fqid", "room_fqid", "text"]
METRIC_COLUMNS = ["elapsed_time_diff", "hover_duration"]
NUMERIC_COLUMNS = [
    "elapsed_time_diff", "hover_duration", "room_coor_x", "room_coor_y",
    "screen_coor_x", "screen_coor_y", "location_x_diff", "location_y_diff",
]
QUANTILES = ["0.1", "0.2", "0.5", "0.75"]


@dataclass(frozen=True)
class Landmark:
    """Named span of a phase: rows where every column of any one alternative matches."""

    name: str
    phase: str
    any_of: tuple[dict[str, str], ...]


# Landmark events of the game, by phase.
LANDMARKS = [
    Landmark("logbook_bingo", "5-12", ({"text": "Here's the log book."}, {"fqid": "logbook.page.bingo"})),
    Landmark("reader_bingo", "5-12",
             ({"event_name": "navigate_click", "fqid": "reader"}, {"fqid": "reader.paper2.bingo"})),
    Landmark("journals_bingo", "5-12",
             ({"event_name": "navigate_click", "fqid": "journals"}, {"fqid": "journals.pic_2.bingo"})),
    Landmark("reader_flag", "13-22",
             ({"event_name": "navigate_click", "fqid": "reader_flag"},
              {"fqid": "tunic.library.microfiche.reader_flag.paper2.bingo"})),
    Landmark("journals_flag", "13-22",
             ({"event_name": "navigate_click", "fqid": "journals_flag"}, {"fqid": "journals_flag.pic_0.bingo"})),
]


def null_token(column: str) -> str:
    return f"{column}_null"


def word_key(word: str) -> str:
    """Column-name part of a word; Spark resolves names case-insensitively, so capitals are spelt out."""
    return word if word == word.lower() else f"{word.lower()}_cap"


def safe_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]+", "_", text)


def unique_names(names: list[str]) -> list[str]:
    """Sanitised names, numbered where two would clash under case-insensitive resolution."""
    seen: dict[str, int] = {}
    out = []
    for name in map(safe_name, names):
        n = seen.get(name.lower(), 0) + 1
        seen[name.lower()] = n
        out.append(name if n == 1 else f"{name}__{n}")
    return out


def phase_prefix(phase: str, phases: list[str] = PHASES) -> str:
    return f"g{phases.index(phase)}_"

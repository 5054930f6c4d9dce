"""Version records: what a table that is stored in parts consists of, and what is known of its rows.

A record lists the folders of every part (a month, say). It is one small file, written after all data, so that readers see
the old state until it is there, whatever part of a write has been done by then. Nothing is renamed. A record that is cut
off is no record: it does not parse.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from batchloom.sources.files import delete, list_names, read_text, write_text

_RECORDS = "_versions"


@dataclass(frozen=True)
class Version:
    """``parts`` maps the name of a part (``month=2001-07-01``) to its folders below the table's folder.

    ``facts`` holds what the writer knew of the rows: highest ids (``max_id``), the least and largest key of a folder (``ranges``),
    the batches applied (``applied``) and the parts before the last of them (``before``). A fact that is not there is not known.
    """

    number: int = 0
    parts: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    facts: Mapping[str, object] = field(default_factory=dict)

    def folders(self) -> set[str]:
        """Everything the version needs, its state before the last batch included."""
        return {f for parts in (self.parts, self.before() or {}) for own in parts.values() for f in own}

    def before(self) -> dict[str, tuple[str, ...]] | None:
        parts = self.facts.get("before")
        return None if parts is None else {name: tuple(own) for name, own in parts.items()}


def _record(folder: str, number: int) -> str:
    return f"{folder}/{_RECORDS}/{number:012d}.json"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all records, complete or not, in order."""
    return sorted(int(n.removesuffix(".json")) for n in list_names(spark, f"{folder}/{_RECORDS}") if n.endswith(".json"))


def read_record(spark: SparkSession, folder: str, number: int) -> Version | None:
    try:
        found = json.loads(read_text(spark, _record(folder, number)))
    except ValueError:
        return None
    return Version(number, {name: tuple(own) for name, own in found["parts"].items()}, found["facts"])


def newest(spark: SparkSession, folder: str) -> Version | None:
    """The newest complete record."""
    for number in reversed(numbers(spark, folder)):
        version = read_record(spark, folder, number)
        if version is not None:
            return version
    return None


def write_record(spark: SparkSession, folder: str, version: Version) -> None:
    """Publish a version. Another writer that has taken the number already makes this an error, so no publish is lost."""
    text = json.dumps({"parts": {name: list(own) for name, own in version.parts.items()}, "facts": dict(version.facts)})
    write_text(spark, _record(folder, version.number), text)


def drop_records(spark: SparkSession, folder: str, chosen: Iterable[int]) -> None:
    for number in chosen:
        delete(spark, _record(folder, number))

"""Numbered change files: paths, states, fetching, and a stream over them."""

from __future__ import annotations

import os
import re
import shutil
import time
import urllib.request
from email.utils import parsedate_to_datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from graphshed.model import ELEMENT
from graphshed.sources.xml import ElementReader, _File, pieces

# How often an address is tried, and the seconds between.
TRIES, PAUSE = 5, 1.0


class StateNotFound(ValueError):
    """No state text."""


class StateIncorrect(ValueError):
    """A state text without a sequence number."""


def path_of(sequence: int) -> str:
    """AAA/BBB/CCC, each part modulo 1000."""
    return "/".join(f"{sequence // d % 1000:03d}" for d in (1_000_000, 1000, 1))


def sequence_of(text: str) -> int:
    """The number in the first line that begins with ``sequenceNumber=``."""
    for line in text.splitlines():
        if line.startswith("sequenceNumber="):
            try:
                return int(line.split("=")[1])
            except ValueError:
                raise StateIncorrect(line) from None
    raise StateIncorrect("no sequenceNumber line")


def read_state(place: str) -> int:
    """The sequence number of a state file or address."""
    try:
        if is_address(place):
            with urllib.request.urlopen(place, timeout=30) as f:
                text = f.read().decode()
        else:
            with open(place.removeprefix("file://"), encoding="utf-8") as f:
                text = f.read()
    except OSError as e:
        raise StateNotFound(place) from e
    return sequence_of(text)


def fetch(place: str, target: str) -> None:
    """Copies a file or address to a path: under another name first, with its time of modification, then renamed. Addresses are tried TRIES times."""
    part = f"{target}.part"
    if is_address(place):
        for left in reversed(range(TRIES)):
            try:
                with urllib.request.urlopen(place, timeout=60) as f, open(part, "wb") as out:
                    shutil.copyfileobj(f, out)
                    changed = f.headers.get("Last-Modified")
                if changed:
                    stamp = parsedate_to_datetime(changed).timestamp()
                    os.utime(part, (stamp, stamp))
                break
            except OSError:
                if not left:
                    raise
                time.sleep(PAUSE)
    else:
        shutil.copy2(place.removeprefix("file://"), part)
    os.replace(part, target)


def pending(current: Column, remote: Column, most: Column | None = None) -> Column:
    """The sequences after the current one up to the remote one, or to ``most`` if that is smaller."""
    last = remote if most is None else F.least(remote, most)
    return F.when(last > current, F.sequence(current + 1, last)).otherwise(F.array().cast("array<bigint>"))


def is_address(place: str) -> bool:
    return re.match("https?:", place) is not None


def mirror(address: str, folder: str, current: int, most: int | None = None) -> int:
    """Fetches the change files and states after the current sequence from an address into a folder laid out like it; returns the last one.

    A file that is there is not fetched again, and the folder's state moves
    only when a sequence is whole, so what broke off is taken up again.
    """
    from graphshed.sinks.files import publish_state

    remote = read_state(f"{address}/state.txt")
    last = remote if most is None else min(remote, most)
    for n in range(current + 1, last + 1):
        path = path_of(n)
        os.makedirs(os.path.dirname(f"{folder}/{path}"), exist_ok=True)
        for ending in (".osc.gz", ".state.txt"):
            if not os.path.exists(f"{folder}/{path}{ending}"):
                fetch(f"{address}/{path}{ending}", f"{folder}/{path}{ending}")
        publish_state(folder, n, f"{path}.state.txt")
    return max(last, current)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(sequence, file) of the change files below a folder, laid out by ``path_of``."""
    rows = []
    for top, _, names in os.walk(folder):
        for name in names:
            m = re.fullmatch(r"(?:.*/)?(\d{3})/(\d{3})/(\d{3})\.os[cm](?:\.gz)?", f"{top}/{name}")
            if m:
                rows.append((int("".join(m.groups())), f"{top}/{name}"))
    return spark.createDataFrame(rows, "sequence bigint, file string").orderBy("sequence")


class _Numbered(InputPartition):
    def __init__(self, sequence: int, piece: _File):
        self.sequence, self.piece = sequence, piece


class ChangeStreamReader(DataSourceStreamReader):
    """Offsets are sequence numbers; a batch has the files after its start up to its end."""

    def __init__(self, schema, options):
        self.schema, self.folder = schema, options["path"].removeprefix("file://").rstrip("/")
        self.first, self.most = int(options.get("startsequence", 0)), options.get("endsequence")

    def initialOffset(self) -> dict:  # noqa: N802
        return {"sequence": self.first}

    def latestOffset(self) -> dict:  # noqa: N802
        remote = read_state(f"{self.folder}/state.txt")
        return {"sequence": max(self.first, remote if self.most is None else min(remote, int(self.most)))}

    def partitions(self, start: dict, end: dict):
        found = []
        for n in range(start["sequence"] + 1, end["sequence"] + 1):
            base = f"{self.folder}/{path_of(n)}"
            path = next((p for p in (f"{base}.osc.gz", f"{base}.osc") if os.path.exists(p)), None)
            if path is None:
                raise FileNotFoundError(f"{base}.osc.gz")
            found += [_Numbered(n, piece) for piece in pieces(path)]
        return found

    def read(self, partition: _Numbered):
        import pyarrow as pa

        inner = type(self.schema)([f for f in self.schema.fields if f.name != "sequence"])
        for batch in ElementReader(inner, []).read(partition.piece):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.repeat(pa.scalar(partition.sequence, pa.int64()), batch.num_rows)], [*batch.schema.names, "sequence"])

    def commit(self, end: dict) -> None:
        pass


class ChangeStream(DataSource):
    """Format ``graph_changes``: a stream over the numbered change files of a folder with ``state.txt``.

    Options: path, startSequence (the last one already done), endSequence.
    """

    @classmethod
    def name(cls) -> str:
        return "graph_changes"

    def schema(self) -> str:
        return f"{ELEMENT}, file string, sequence bigint"

    def streamReader(self, schema) -> ChangeStreamReader:  # noqa: N802
        return ChangeStreamReader(schema, self.options)


def stream(spark: SparkSession, folder: str, start: int = 0, most: int | None = None) -> DataFrame:
    spark.dataSource.register(ChangeStream)
    reader = spark.readStream.format("graph_changes").option("startSequence", str(start))
    if most is not None:
        reader = reader.option("endSequence", str(most))
    return reader.load(folder)


def states(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """The rows with ``sequence``; a text without a number is an error."""
    from graphshed.functions.codecs import sequence_of as parsed

    wrong = F.raise_error(F.concat(F.lit("state incorrect: "), F.col(text_col))).cast("bigint")
    return texts.withColumn("sequence", F.coalesce(parsed(F.col(text_col)), wrong))

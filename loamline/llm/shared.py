"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.session import checkpoint_dir

#: White space of the word and text rules: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A folder of its own for this call, below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, lineage cut there."""
    uri = scratch_uri(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an absolute path or a URI such as file:, hdfs: or s3:."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, stem: str, suffix: str) -> tuple[str, object]:
    """Name and stream of a file that no other attempt of the task writes.

    A repeated task writes a second file; only files named in the manifest that Spark
    commits are ever read.
    """
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}{suffix}"
    return name, system.open_output_stream(f"{path}/{name}", compression=None)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that stand for much work (files), dealt out by their columns.

    With the number given, adaptive execution does not merge partitions for being small.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words: each run of word characters shrinks to one sign, blanks go."""
    return F.length(F.regexp_replace(F.regexp_replace(text, WORD, "x"), BLANKS + "+", ""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows as one column ``doc`` beside the named ones, so that the names of an operator
    cannot clash with those of the table; ``unpacked`` gives the rows back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *[c.alias(n) for n, c in columns.items()])


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("doc.*")


class Remembered:
    """Values of equal strings, worked out once, in two generations of bounded size.

    A full young generation becomes the old one; what is met again moves back. So frequent
    strings stay and memory does not grow with the data.
    """

    def __init__(self, learn, limit: int, longest: int):
        self.learn, self.limit, self.longest = learn, limit, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, lists: list[list[str]]) -> list[list[bytes]]:
        """The value of every string of every list."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = set().union(*lists).difference(young)
        if new:
            met = new.intersection(old)
            young.update(zip(met, map(old.__getitem__, met)))
            fresh = list(new.difference(met))
            young.update(zip(fresh, self.learn(fresh)))
        out = [list(map(young.__getitem__, strings)) for strings in lists]
        for string in [s for s in new if len(s) > self.longest]:
            del young[string]
        return out

    def of_different(self, strings: list[str]) -> list[bytes]:
        """The value of every string of a list in which none stands twice."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, strings))
        places = [i for i, value in enumerate(found) if value is None]
        new = [strings[i] for i in places]
        values = list(map(self.old.get, new))
        fresh = [s for s, value in zip(new, values) if value is None]
        learned = iter(self.learn(fresh))
        for place, string, value in zip(places, new, values):
            found[place] = value = next(learned) if value is None else value
            if len(string) <= self.longest:
                self.young[string] = value
        return found

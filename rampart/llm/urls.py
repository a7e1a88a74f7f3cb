"""URL rules as a sorted digest array.

A rule is a host, a path and a verdict.  The rules are written once as a file: sorted
64-bit xxhash keys of ``host`` + ``path``, and the rules' strings in the same order.
Tasks map the file into memory, probe it with a vectorised binary search for every rule
that could fit a url, and compare the stored strings, so two strings with equal digests
are never mistaken for each other.

Rows: a url that is NULL or has no ``://`` has an empty host and path and no rule.  Each
row is judged by itself, repeated ids too; columns of the input other than the url and
the kept ones are not used.  Without rules every url gets the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions.session import fresh_path

# The file goes to every executor's disk.  A longer list is refused, not cut.
MAX_RULE_BYTES = 2 << 30
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CHUNK = 1 << 22


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


class DigestArray:
    """The mapped file: keys, string offsets, strings, verdict per rule.

    Layout: five int64 (rules, string bytes, label counts, path lengths, 0), the distinct
    label counts of hosts and lengths of paths that rules have, keys, offsets, verdicts
    (1: block), strings.
    """

    def __init__(self, path: str) -> None:
        head = np.fromfile(path, np.int64, 5)
        n, size, labels, lengths, _ = head.tolist()
        at = 40

        def part(kind: type, count: int) -> np.ndarray:
            nonlocal at
            found = np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind)
            at += found.nbytes
            return found

        self.labels, self.lengths = set(part(np.int64, labels).tolist()), sorted(part(np.int64, lengths).tolist())
        self.keys, self.offsets = part(np.uint64, n), part(np.int64, n + 1)
        self.verdicts, self.strings = part(np.uint8, n), part(np.uint8, size)

    def find(self, probes: list[bytes]) -> np.ndarray:
        """Row of each probe among the rules, -1 where there is none."""
        keys = np.fromiter(map(_key, probes), np.uint64, len(probes))
        rows = np.full(len(probes), -1)
        at = np.searchsorted(self.keys, keys)
        for place in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys) if len(self.keys) else ():
            row = int(at[place])
            while row < len(self.keys) and self.keys[row] == keys[place]:
                if self.strings[self.offsets[row] : self.offsets[row + 1]].tobytes() == probes[place]:
                    rows[place] = row
                    break
                row += 1
        return rows

    def candidates(self, host: str, path: str) -> list[bytes]:
        """All rule strings that could fit, longest first; of equal length the longer
        host first."""
        labels = host.split(".")
        suffixes = [".".join(labels[-n:]) for n in sorted(self.labels) if n <= len(labels)]
        prefixes = [path[:n] for n in self.lengths if n <= len(path)]
        pairs = sorted(((h, p) for h in suffixes for p in prefixes), key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))
        return [f"{h}\0{p}".encode() for h, p in pairs]


@lru_cache(maxsize=4)
def _mapped(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def _build(rules: DataFrame, path: str) -> None:
    """Write the digest file.  Rules stream through the driver in sorted order of their
    digests; memory there is bounded by ``MAX_RULE_BYTES``."""
    spark = rules.sparkSession
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + F.lit(32))).first()[0] or 0
    if size > MAX_RULE_BYTES:
        raise ValueError(f"rules take {size} bytes, more than {MAX_RULE_BYTES}")
    rows = {}
    for host, way, verdict in rules.select("host", "path", "verdict").toLocalIterator():
        # Of two verdicts for one rule, block stands.
        text = f"{host}\0{way}".encode()
        rows[text] = max(rows.get(text, 0), int(verdict == "block"))
    ordered = sorted(rows, key=lambda text: (_key(text), text))
    blob = b"".join(ordered)
    labels = {text.split(b"\0")[0].count(b".") + 1 for text in ordered}
    lengths = {len(text.split(b"\0", 1)[1].decode()) for text in ordered}
    parts = [
        np.array([len(ordered), len(blob), len(labels), len(lengths), 0], np.int64),
        np.array(sorted(labels), np.int64),
        np.array(sorted(lengths), np.int64),
        np.array([_key(text) for text in ordered], np.uint64),
        np.append(0, np.cumsum([len(text) for text in ordered], dtype=np.int64)).astype(np.int64),
        np.array([rows[text] for text in ordered], np.uint8),
        np.frombuffer(blob, np.uint8),
    ]
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    for part in parts:
        data = part.tobytes()
        for start in range(0, len(data), _CHUNK):
            out.write(data[start : start + _CHUNK])
    out.close()


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow") -> DataFrame:
    """The ``keep`` columns, host, path, the longest rule that fits (else NULL) and its
    verdict (else ``default``).

    A rule fits its host and all hosts below it, if the url's path starts with the rule's.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "digests")
    _build(rules, path)
    spark.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[1]
    kept = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = _mapped(name)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            probes = [array.candidates(h, p) for h, p in zip(hosts, paths)]
            stops = np.cumsum([len(x) for x in probes])
            rows = array.find([text for x in probes for text in x])
            found, verdicts = [], []
            for stop, own in zip(stops.tolist(), probes):
                hits = np.flatnonzero(rows[stop - len(own) : stop] >= 0)
                found.append(own[hits[0]].decode().replace("\0", "") if len(hits) else None)
                verdicts.append(
                    ("block" if array.verdicts[rows[stop - len(own) + hits[0]]] else "allow") if len(hits) else default
                )
            columns = [*batch.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "rule", "verdict"])

    return kept.mapInArrow(probe, f"{schema}, rule string, verdict string")

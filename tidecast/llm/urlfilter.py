"""URL filter: rules in a sorted, memory-mapped array of 64-bit digests, probed by binary search."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.llm.common import worker_store
from tidecast.session import scratch_path

#: Rules in one sorted file.
SHARD_RULES = 1 << 22
RULE_FIELDS = "host string, path string, verdict string"


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        kind, path = fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
        return kind, path
    return fs.LocalFileSystem(), uri


def _write(uri: str, data: bytes) -> None:
    """Write a whole file; a task that runs again replaces it with the same bytes."""
    kind, path = _filesystem(uri)
    with kind.open_output_stream(path) as out:
        out.write(data)


def _mapped(uri: str) -> np.ndarray:
    """The bytes of a file as a memory map; from a remote store a worker fetches it once."""
    store = worker_store("mapped")
    if uri not in store:
        kind, path = _filesystem(uri)
        if kind.type_name != "local":
            import tempfile

            with tempfile.NamedTemporaryFile(delete=False) as copy, kind.open_input_stream(path) as data:
                while part := data.read(1 << 22):
                    copy.write(part)
            path = copy.name
        store[uri] = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    return store[uri]


class RuleList:
    """Where the sorted files of a rule list are, the digests they start with, and the path lengths of its rules."""

    def __init__(self, folder: str, firsts: Sequence[int], lengths: Sequence[int]):
        self.folder, self.firsts, self.lengths = folder, np.array(firsts, np.uint64), sorted(lengths)

    def find(self, keys: list[str]) -> list[str | None]:
        """The verdict of every key, None where it is no rule."""
        out: list[str | None] = [None] * len(keys)
        if not len(self.firsts) or not keys:
            return out
        digests = np.fromiter(map(digest, keys), np.uint64, len(keys))
        shards = np.searchsorted(self.firsts, digests, "right") - 1
        for shard in np.unique(shards[shards >= 0]).tolist():
            probe = np.flatnonzero(shards == shard)
            sorted_digests = _mapped(f"{self.folder}/{shard}.digests").view("<u8")
            offsets = _mapped(f"{self.folder}/{shard}.offsets").view("<u8")
            strings = _mapped(f"{self.folder}/{shard}.strings")
            low = np.searchsorted(sorted_digests, digests[probe], "left")
            high = np.searchsorted(sorted_digests, digests[probe], "right")
            for i, a, b in zip(probe[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                for at in range(a, b):  # equal digests: the stored string decides
                    stored = strings[int(offsets[at]):int(offsets[at + 1])].tobytes().decode("utf-8", "surrogatepass")
                    key, verdict = stored.rsplit("\n", 1)
                    if key == keys[i]:
                        out[i] = verdict
                        break
        return out


def build_rules(rules: DataFrame) -> RuleList:
    """Sort rules (host, path, verdict) by digest into files in the shared folder.

    Rules are dealt to files by digest range and sorted there, one file per task, so a list of any length fits.
    Of rules with equal host and path a ``block`` wins; rows with a null column are no rules.
    """
    spark = rules.sparkSession
    folder = scratch_path(spark, "rules")
    key = F.concat(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.col("path"))
    named = (rules.select(key.alias("key"), F.length("path").alias("n"), "verdict").dropna()
             .groupBy("key", "n").agg(F.max(F.col("verdict") == "block").alias("blocked"), F.max("verdict").alias("verdict"))
             .select("key", "n", F.when(F.col("blocked"), "block").otherwise(F.col("verdict")).alias("verdict")))
    counted = named.agg(F.count(F.lit(1)), F.collect_set("n")).first()
    shards = max(1, -(-counted[0] // SHARD_RULES))
    kind, path = _filesystem(folder)
    kind.create_dir(path, recursive=True)

    def with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [f"{k.as_py()}" for k in batch.column(0)]
            hashes = [digest(k) for k in keys]
            yield pa.RecordBatch.from_arrays([
                pa.array([h * shards >> 64 for h in hashes], pa.int64()), pa.array([f"{h:016x}" for h in hashes]),
                pa.array([f"{k}\n{v.as_py()}" for k, v in zip(keys, batch.column(1))])], ["shard", "digest", "stored"])

    def store(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["digest"].to_pylist(), table["stored"].to_pylist()))
        shard, stored = table["shard"][0].as_py(), [s.encode("utf-8", "surrogatepass") for _, s in rows]
        _write(f"{folder}/{shard}.digests", np.array([int(d, 16) for d, _ in rows], "<u8").tobytes())
        _write(f"{folder}/{shard}.offsets", np.cumsum([0, *map(len, stored)]).astype("<u8").tobytes())
        _write(f"{folder}/{shard}.strings", b"".join(stored))
        return pa.table({"shard": pa.array([shard], pa.int64()), "first": [rows[0][0]]})

    dealt = named.select("key", "verdict").mapInArrow(with_digest, "shard long, digest string, stored string")
    files = {r.shard: int(r.first, 16) for r in dealt.groupBy("shard").applyInArrow(store, "shard long, first string").collect()}
    for empty in set(range(shards)) - set(files) if files else ():
        for part in ("digests", "offsets", "strings"):
            _write(f"{folder}/{empty}.{part}", np.zeros(1, "<u8").tobytes() if part == "offsets" else b"")
    firsts = [-(-(i << 64) // shards) for i in range(shards)] if files else []
    return RuleList(folder, firsts, counted[1])


def split_url(url: str | None) -> tuple[str, str]:
    """Host (ASCII letters lower-cased) and path; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in (rest.find(c, end) for c in "?#") if i >= 0), default=len(rest))
    host = rest[:end].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return host, rest[end:path_end]


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Every rule that would fit: suffixes of the host at dots, with prefixes of the path; longest first, then
    the longer host.
    """
    parts = host.split(".")
    hosts = [".".join(parts[i:]) for i in range(len(parts))]
    return [h + path[:n] for _, _, h, n in sorted((-len(h) - n, -len(h), h, n) for h in hosts for n in lengths if n <= len(path))]


def filter_urls(pages: DataFrame, rules: RuleList, default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` (page_id, url): page_id, host, path, rule, verdict; one row per row.

    A rule fits its host and every subdomain if the path starts with the rule's; the longest wins.  Without one
    ``rule`` is null and the verdict is ``default``.  The key of a rule is host and path together: a candidate
    can equal a rule only with the same host, since a path starts with a slash.  A null url, one without
    ``://`` and an empty host fit no rule unless one is stored for them; repeated rows are judged each, and so are rows without
    page_id; a very long url costs its length, as only prefixes as long as some rule are looked up; two rules of one length
    cannot both fit.  An empty table gives an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_url(u.as_py()) for u in batch.column(1)]
            keys = [candidates(h, p, rules.lengths) for h, p in split]
            flat = rules.find([k for ks in keys for k in ks])
            rule, verdict, at = [], [], 0
            for ks in keys:
                hit = next((i for i in range(at, at + len(ks)) if flat[i] is not None), None)
                rule.append(None if hit is None else ks[hit - at])
                verdict.append(default if hit is None else flat[hit])
                at += len(ks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h for h, _ in split], pa.string()),
                                              pa.array([p for _, p in split], pa.string()), pa.array(rule, pa.string()),
                                              pa.array(verdict, pa.string())],
                                             ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col("page_id").cast("long"), "url").mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string")


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_FIELDS)

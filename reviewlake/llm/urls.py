"""URL filter: a sorted array of 64-bit digests, memory-mapped by every worker, and the full strings behind it."""

from __future__ import annotations

import json
import mmap

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns, others, share_file
from reviewlake.session import materialize

#: Largest rule table in bytes that executors map as one file; it also passes through the driver.
RULE_BYTES = 64 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OUT = "rule string, verdict string"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1)


def key_of(rule: str) -> int:
    return xxhash.xxh64_intdigest(rule)


class RuleTable:
    """Rules as one mapped file: sorted digests, for each the place of its full string, then the strings.

    `DIGESTS | PLACES | VERDICTS | STRINGS`, after a header line of JSON. The processes of an executor map the same
    file read-only and share its pages.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        start = self.map.find(b"\n") + 1
        head = json.loads(self.map[:start])
        size, self.lengths, self.host_lengths, self.verdicts = (head[key] for key in ("rules", "lengths", "hosts", "verdicts"))
        self.digests = np.frombuffer(self.map, "<u8", size, start)
        self.places = np.frombuffer(self.map, "<i8", size + 1, start + 8 * size)
        self.verdict = np.frombuffer(self.map, "u1", size, start + 16 * size + 8)
        self.strings = start + 17 * size + 8

    @staticmethod
    def pack(rules: list[tuple[str, str, str]]) -> bytes:
        """rules: host, path, verdict. Equal rules are one, with the smallest of their verdicts."""
        verdicts = sorted({verdict for _, _, verdict in rules})
        chosen: dict[str, int] = {}
        lengths, hosts = set(), set()
        for host, path, verdict in sorted(rules, key=lambda rule: rule[2], reverse=True):
            chosen[host + path] = verdicts.index(verdict)
            lengths.add(len(path))
            hosts.add(len(host))
        order = sorted(chosen, key=lambda rule: (key_of(rule), rule))
        strings = [rule.encode() for rule in order]
        line = json.dumps({"rules": len(order), "verdicts": verdicts, "lengths": sorted(lengths),
                           "hosts": sorted(hosts)}).encode()
        line += b" " * (-(len(line) + 1) % 8) + b"\n"
        return b"".join([line, np.array([key_of(rule) for rule in order], "<u8").tobytes(),
                         np.cumsum([0, *map(len, strings)], dtype="<i8").tobytes(),
                         np.array([chosen[rule] for rule in order], "u1").tobytes(), *strings])

    def candidates(self, host: str, path: str) -> list[str]:
        """Every string that a fitting rule could be, longest first; of equal lengths the smaller string first.

        Only ends of the host that are as long as the host of some rule are tried, however many labels it has.
        """
        starts = [len(host) - size for size in self.host_lengths if size <= len(host)]
        hosts = [host[start:] for start in starts if start in (0, len(host)) or host[start - 1] == "."]
        found = {name + path[:size] for name in hosts for size in self.lengths if size <= len(path)}
        return sorted(found, key=lambda rule: (-len(rule), rule))

    def judge(self, hosts: list[str], paths: list[str], otherwise: str) -> tuple[list, list]:
        """The longest fitting rule of each url and its verdict."""
        tried = [self.candidates(host, path) for host, path in zip(hosts, paths)]
        flat = [rule for each in tried for rule in each]
        keys = np.fromiter(map(key_of, flat), np.uint64, len(flat))
        first = np.searchsorted(self.digests, keys)
        hit = np.zeros(len(flat), bool)
        inside = first < len(self.digests)
        hit[inside] = self.digests[first[inside]] == keys[inside]
        owner = np.repeat(np.arange(len(tried)), [len(each) for each in tried])
        rules, verdicts = [None] * len(hosts), [otherwise] * len(hosts)
        for at in np.flatnonzero(hit):  # longest first within a url
            if rules[owner[at]] is None:
                place = self.confirm(int(first[at]), int(keys[at]), flat[at].encode())
                if place is not None:
                    rules[owner[at]], verdicts[owner[at]] = flat[at], self.verdicts[self.verdict[place]]
        return rules, verdicts

    def confirm(self, place: int, key: int, rule: bytes) -> int | None:
        """The place of the full string among those of its digest."""
        while place < len(self.digests) and int(self.digests[place]) == key:
            start, end = self.strings + int(self.places[place]), self.strings + int(self.places[place + 1])
            if self.map[start:end] == rule:
                return place
            place += 1
        return None


def filter_urls(df: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow",
                keep: list[str] | None = None, rule_bytes: int = RULE_BYTES) -> DataFrame:
    """Adds host, path, rule and verdict to every row.

    rules: columns host, path, verdict; a null host or path is empty, a null verdict is 'block'; a host is a literal
    in which A-Z count as a-z, an empty one fits all. A rule fits its host and all subdomains if the url's path starts
    with its path. The longest fitting rule (host and path together; of equal lengths the smaller string) gives the
    verdict; without one it is `otherwise` and the rule is null. A null url, and one without `://`, has an empty host
    and path. Empty tables give empty results; repeated rows and other columns stay; columns named like new ones are
    replaced.

    The rules' size is counted first. Up to `rule_bytes` they are one file that every executor maps. Beyond that they
    are cut by digest into files of that size, which are probed one after the other, with the rows stored in between,
    so that no more than one file is in use at a time.
    """
    spark = df.sparkSession
    # the path of a url is empty or begins with `/`, so that other rules fit nothing
    rules = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, UPPER.lower()).alias("host"),
                         F.coalesce("path", F.lit("")).alias("path"),
                         F.coalesce("verdict", F.lit("block")).alias("verdict")
                         ).where((F.col("path") == "") | F.startswith("path", F.lit("/")))
    total = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 17)).first()[0] or 0
    blocks = total // rule_bytes + 1
    kept = others(df, ["host", "path", "rule", "verdict"], keep)
    judged = ["host", "path", "rule", "verdict"]
    found = df.select(*[df[name] for name in kept], host_of(df[url]).alias("host"), path_of(df[url]).alias("path"),
                      F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    for block in range(blocks):
        some = rules if blocks == 1 else rules.where(F.pmod(F.xxhash64("host", "path"), F.lit(blocks)) == block)
        name = share_file(spark, RuleTable.pack([tuple(row) for row in some.collect()]), "url-rules")
        found = add_columns(found, judged, OUT, _probe(name, otherwise), [*kept, "host", "path"])
        if block < blocks - 1:
            found = materialize(found, "judged")
    return found


def _probe(name: str, otherwise: str):
    def start():
        table = RuleTable(SparkFiles.get(name))

        def rows(hosts, paths, before, said):
            rules, verdicts = table.judge(hosts, paths, otherwise)
            for at, old in enumerate(before):  # the longer rule of an earlier file stays
                if old is not None and (rules[at] is None or (-len(old), old) < (-len(rules[at]), rules[at])):
                    rules[at], verdicts[at] = old, said[at]
            return rules, verdicts
        return rows
    return start

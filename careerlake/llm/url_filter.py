"""Allow and block rules over URLs, by a trie of reversed host labels and path segments.

A rule is a host and a path. It fits a URL if the URL's host is the rule's or one of its subdomains and the URL's path starts with the
rule's, character by character. Each rule hangs in the trie under its host's labels, last label first, then under the segments of its
path that a slash ends; what follows the last slash is kept at that node as a tail, which need only begin the URL's next
segment. A URL walks down by its labels, and from each host that has rules by its segments, so it costs its own length whatever the number of
rules. Of the rules that fit the longest wins: most characters of host and path, then the longer host; of an allow and a
block rule that are the same, block.

The trie is sent to all tasks only while the rules are within a stated number and size; beyond, URLs meet the rules in a join by
the hosts and segments that they could hang under, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved

VERDICTS = ("allow", "block")
#: Bounds of what is sent to all tasks as a trie.
MOST_RULES, MOST_BYTES = 200_000, 16 << 20
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is no :// or no URL."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


class Trie:
    """Rules (verdict, host, path) by reversed host labels and path segments."""

    __slots__ = ("hosts",)

    def __init__(self, rules: list[tuple[str, str, str]] = ()):
        self.hosts: dict = {}  # label -> [hosts below, [segments below, tails]]
        for verdict, host, path in rules:
            self.add(verdict, host, path)

    def add(self, verdict: str, host: str, path: str) -> None:
        below, node = self.hosts, None
        for label in reversed(host.split(".")):
            node = below.setdefault(label, [{}, None])
            below = node[0]
        node[1] = at = node[1] or [{}, {}]
        *whole, tail = path.split("/")
        for segment in whole:
            at = at[0].setdefault(segment, [{}, {}])
        if at[1].get(tail, ("",))[0] != "block":
            at[1][tail] = (verdict, host + path, (len(host) + len(path), len(host)))

    def _path(self, at: list, parts: list[str], best: tuple | None) -> tuple | None:
        last = len(parts) - 1
        for i, part in enumerate(parts):
            below, tails = at
            for tail, rule in tails.items() if len(tails) <= len(part) else ((t, tails[t]) for n in range(len(part) + 1) if (t := part[:n]) in tails):
                if part.startswith(tail) and (best is None or rule[2] > best[2]):
                    best = rule
            if i == last or not (at := below.get(part)):
                break
        return best

    def find(self, host: str, path: str) -> tuple | None:
        """The verdict, the rule and its rank, of the longest rule that fits; None if none does."""
        below, best, parts = self.hosts, None, path.split("/")
        for label in reversed(host.split(".")):
            node = below.get(label)
            if node is None:
                break
            below, at = node
            if at is not None:
                best = self._path(at, parts, best)
        return best


def _checked(rules: DataFrame) -> DataFrame:
    """verdict, host and path of the rules, each once; a null host or path is empty, rows without a verdict are no rules."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    of = rules.filter("verdict is not null").select(F.col("verdict").cast("string").alias("verdict"), lower_ascii(text("host")).alias("host"), text("path").alias("path"))
    strange = of.filter(~F.col("verdict").isin(*VERDICTS)).select("verdict").first()
    if strange:
        raise ValueError(f"a rule's verdict is allow or block, not {strange['verdict']!r}")
    return of.distinct()


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url", most_rules: int = MOST_RULES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Per row: id, host, path, rule (host and path of the rule that decides; null if none fits) and verdict (allow or block; default where no rule fits).

    rules has verdict, host and path, and may be empty. A rule with an empty host fits URLs without a host only. A null URL, or one without ://, has an
    empty host and path. Bytes that aren't UTF-8 become U+FFFD. Ids may be null or repeat: each row gets its own verdict; further columns are ignored; an
    empty table gives an empty result. URLs of any length are judged whole. Up to most_rules rules of most_bytes characters in all go to every task as a trie; more are joined.
    """
    if default not in VERDICTS:
        raise ValueError("default is allow or block")
    url = F.make_valid_utf8(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = Saved(_checked(rules), "url-rules").df
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)).alias("chars")).first()
    found = _by_trie(rows, known) if size["n"] <= most_rules and size["chars"] <= most_bytes else _by_join(rows, known)
    return found.select(F.col("page_id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _by_trie(rows: DataFrame, rules: DataFrame) -> DataFrame:
    trie = rows.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in rules.collect()]))  # judge has checked the number and size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for b in batches:
            best = [find(h, p) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x and x[1] for x in best], pa.string()), pa.array([x and x[0] for x in best], pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string")


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same as a join: hosts and folders of the distinct URLs, as deep as any rule goes, against those of the rules; the longest rule by URL."""
    deep = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.size(F.split("path", "/"))).alias("parts")).first()
    folder, tail = r"(?s)^(.*/)?[^/]*$", r"(?s)([^/]*)$"
    kept = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block is the larger
    kept = kept.select(F.col("host").alias("at"), F.regexp_extract("path", folder, 1).alias("folder"), F.regexp_extract("path", tail, 1).alias("tail"), F.concat("host", "path").alias("rule"), "verdict")
    urls = rows.select("host", "path").distinct()
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deep["labels"] or 1))), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    # each folder that the path is in, with the segment that follows
    above = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(deep["parts"] or 1))), lambda i: F.struct(F.when(i == 1, "").otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i - 1), "/"), F.lit("/"))).alias("folder"), F.element_at(parts, i).alias("next")))
    asked = urls.withColumn("at", F.explode(hosts)).withColumn("f", F.explode(above)).select("host", "path", "at", "f.folder", "f.next")
    met = asked.join(kept, ["at", "folder"]).filter(F.startswith("next", "tail"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.length("at"))).alias("best"))
    return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", "best.rule", "best.verdict")


#: The rules of the query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def oracle_sql() -> str:
    """The query's result by plain SQL: every rule is tried on every URL."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""with r(verdict, host, path) as (values {values}),
      p as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, row_number() over () as n from pages),
      m as (select n, r.host || r.path as rule, r.verdict, row_number() over (partition by n order by length(r.host) + length(r.path) desc, length(r.host) desc, r.verdict desc) as place
        from p join r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
      select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join m on m.n = p.n and place = 1"""

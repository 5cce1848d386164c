"""Registered domain of a URL, by public suffix rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import urls
from tidings.functions.binding import let
from tidings.operators.joins import lookup_join
from tidings.session import local_table

# A few suffixes for tests and trials. A run takes a rule file (``read_suffix_rules``): by these
# names alone two sites below com.br, which they do not hold, would be one domain.
COMMON_SUFFIXES = (
    "com", "net", "org", "info", "edu", "gov", "int", "eu", "de", "fr", "es", "it", "pl", "ua",
    "by", "kz", "ru", "su", "рф", "xn--p1ai", "com.ru", "msk.ru", "spb.ru", "uk", "co.uk", "org.uk",
    "ac.uk", "gov.uk", "jp", "co.jp", "cn", "com.cn", "test",
)


# The Public Suffix List holds about 10^4 rules; up to this many a broadcast stays small.
BROADCAST_RULES = 200_000


class SuffixRules(NamedTuple):
    """Rules by base name, the most labels in a base, and whether a broadcast is known small."""

    table: DataFrame
    depth: int
    small: bool


@F.arrow_udf(T.StringType())
def _ascii_form(names: pa.Array) -> pa.Array:
    """The ASCII form of a domain name, as links carry it; a name that has none stays."""

    def one(name: str) -> str:
        try:
            return name.encode("idna").decode()
        except UnicodeError:
            return name

    return pa.array([None if n is None else one(n) for n in names.to_pylist()], pa.string())


def _parse(lines: DataFrame) -> DataFrame:
    line = F.regexp_extract("value", r"^\s*(\S+)", 1)
    rules = lines.select(F.lower(line).alias("rule")).filter(
        (F.col("rule") != "") & ~F.startswith("rule", F.lit("//"))
    )
    base = F.regexp_replace("rule", r"^(?:!|\*\.)", "")
    based = rules.select(
        F.explode(F.array_distinct(F.array(base, _ascii_form(base)))).alias("base"),
        F.startswith("rule", F.lit("!")).alias("exception"),
        F.startswith("rule", F.lit("*.")).alias("wildcard"),
    )
    flags = based.groupBy("base").agg(
        F.max(~F.col("exception") & ~F.col("wildcard")).alias("plain"),
        F.max("wildcard").alias("wildcard"),
        F.max("exception").alias("exception"),
    )
    return flags.withColumn("labels", F.size(F.split("base", r"\.")))


def suffix_rules(spark: SparkSession, suffixes: Iterable[str] = COMMON_SUFFIXES) -> SuffixRules:
    """Rules from names such as ``co.uk``, ``*.ck`` and ``!www.ck``."""
    names = list(suffixes)
    bases = [name.removeprefix("!").removeprefix("*.") for name in names]
    depth = max((base.count(".") + 1 for base in bases), default=0)
    lines = local_table(spark, [(name,) for name in names], "value string")
    return SuffixRules(_parse(lines), depth, len(names) <= BROADCAST_RULES)


def read_suffix_rules(spark: SparkSession, path: str) -> SuffixRules:
    """Rules from a file in the Public Suffix List format."""
    table = _parse(spark.read.text(path))
    found = table.agg(F.coalesce(F.max("labels"), F.lit(0)).alias("depth"), F.count(F.lit(1)).alias("n")).first()
    return SuffixRules(table, found.depth, found.n <= BROADCAST_RULES)


PLAIN, WILDCARD, EXCEPTION = 1, 2, 4


def _trie(rules: SuffixRules) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The rules by their labels from the right: labels, and for each node its parent, label and kinds."""
    rows = rules.table.toArrow()
    labels: dict[str, int] = {}
    nodes: dict[tuple[int, int], int] = {}
    kinds = [0]
    flags = sum(np.array(rows.column(c).to_pylist(), dtype=np.int64) * bit for c, bit in (("plain", PLAIN), ("wildcard", WILDCARD), ("exception", EXCEPTION)))
    for base, kind in zip(rows.column("base").to_pylist(), flags.tolist() if rows.num_rows else []):
        node = 0
        for label in reversed(base.split(".")):
            key = node, labels.setdefault(label, len(labels))
            if key not in nodes:
                nodes[key] = len(kinds)
                kinds.append(0)
            node = nodes[key]
        kinds[node] |= kind
    parents, named = (np.array([key[k] for key in nodes], np.int32) for k in (0, 1))
    return list(labels), parents, named, np.array(kinds, np.int8)


def _suffix_labels(rules: SuffixRules) -> Callable[[Column], Column]:
    """A column function from a host to the number of labels of its public suffix by the rules; negative by an exception.

    The trie travels as plain arrays (its rules were counted); each distinct host of a batch is walked once.
    """
    shared = rules.table.sparkSession.sparkContext.broadcast(_trie(rules))

    @F.arrow_udf(T.IntegerType())
    def sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labels, parents, named, kinds = shared.value
        ids = {label: i for i, label in enumerate(labels)}
        nodes = dict(zip(zip(parents.tolist(), named.tolist()), range(1, len(kinds))))
        kinds = kinds.tolist()

        def walk(host: str | None) -> int | None:
            if host is None:
                return None
            parts = host.split(".")
            size = node = 0
            for count, label in enumerate(reversed(parts), 1):
                node = nodes.get((node, ids.get(label, -1)))
                if node is None:
                    break
                kind = kinds[node]
                if kind & EXCEPTION:  # wins, and stands for one label less
                    return -(count - 1)
                if kind & WILDCARD and len(parts) > count:
                    size = count + 1
                elif kind & PLAIN:
                    size = max(size, count)
            return size

        for hosts in batches:
            coded = hosts.dictionary_encode()
            found = pa.array([walk(h) for h in coded.dictionary.to_pylist()], pa.int32())
            yield found.take(coded.indices)

    return sizes


def _matched(df: DataFrame, rules: SuffixRules, url_col: str, tag: str) -> DataFrame:
    """Add the host of a URL and the number of labels in its public suffix.

    Rules of a checked number travel as a trie, and no row moves. More are looked up in joins, one for each
    label count instead of a row per candidate suffix: nothing is exploded, nothing is grouped back.
    """
    host = F.col(f"_host{tag}")
    out = df.withColumn(f"_host{tag}", urls.host(F.col(url_col)))
    labels = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    if rules.small:
        size = _suffix_labels(rules)(host)
    else:
        out, size = _looked_up(out, rules, host, labels, tag)
    is_ip = F.regexp_like(host, F.lit(urls.ADDRESS_PATTERN))
    # Without a rule the last label is the suffix, as the rule set's standard says.
    found = let(size, lambda n: F.when((n == 0) & (labels > 1), F.lit(1)).otherwise(F.abs(n)))
    return out.withColumn(f"_size{tag}", F.when(is_ip, F.lit(-1)).otherwise(found))


def _looked_up(out: DataFrame, rules: SuffixRules, host: Column, labels: Column, tag: str) -> tuple[DataFrame, Column]:
    names = ("plain", "wildcard", "exception")
    size = F.lit(0)
    for count in range(1, rules.depth + 1):
        rule = rules.table.filter(F.col("labels") == count).select(
            F.col("base").alias("_base"), *[F.col(c).alias(f"_{c}{tag}{count}") for c in names]
        )
        # The top label alone is a hot key, so both sides are salted.
        keyed = out.withColumn("_base", F.substring_index(host, ".", -count))
        out = lookup_join(keyed, rule, "_base", broadcast_bytes=-1).drop("_base")
        plain, wildcard, exception = [F.col(f"_{c}{tag}{count}") for c in names]
        # An exception rule wins and stands for one label less; else the longest match.
        size = (
            F.when(exception, F.lit(-(count - 1)))
            .when(size < 0, size)
            .when(wildcard & (labels > count), F.lit(count + 1))
            .when(plain, F.greatest(size, F.lit(count)))
            .otherwise(size)
        )
    return out, size


def _last_labels(host: Column, count: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -count)


def _registered(tag: str) -> Column:
    """The domain with its suffix; a numeric address as it is."""
    host, size = F.col(f"_host{tag}"), F.col(f"_size{tag}")
    return F.when(size < 0, host).otherwise(_last_labels(host, size + 1))


def with_registered_domain(df: DataFrame, rules: SuffixRules, url_col: str = "url") -> DataFrame:
    """Add ``domain`` and ``suffix`` of the URL.

    Without a known rule the last label is the suffix. A host of one label, or a numeric address, is
    the domain itself; a host that is a suffix by a rule has an empty domain.
    """
    out = _matched(df, rules, url_col, "")
    host = F.col("_host")
    size = F.col("_size")
    suffix = F.when(size > 0, _last_labels(host, size)).otherwise("")
    domain = F.when(size <= 0, _registered("")).when(host == suffix, "").otherwise(
        F.substring_index(_registered(""), ".", 1)
    )
    return out.select(*df.columns, domain.alias("domain"), suffix.alias("suffix"))


def within_domain(links: DataFrame, rules: SuffixRules, enabled: bool = True) -> DataFrame:
    """Links whose registered domain equals that of their seed; all links when switched off."""
    if not enabled:
        return links
    named = _matched(_matched(links, rules, "href", "_href"), rules, "seed_url", "_seed")
    same = (F.col("_size_href") == F.col("_size_seed")) & (_registered("_href") == _registered("_seed"))
    return named.filter(same).select(*links.columns)

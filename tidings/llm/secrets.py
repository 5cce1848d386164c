"""Secret scans with multipart credential linking, in DataFrame operations only.

Strong kinds are reported wherever they match: ``assign`` (a named value), ``access`` (an access-key
id) and ``hex`` (a long hexadecimal run). Weak parts - an ``identifier`` with its value, a mixed
``secret`` run, an ``endpoint`` address - say little alone. They are reported only when a
complementary part stands in their scope (``SCOPE`` characters around them, in the same document):
a secret needs an identifier or an endpoint, an identifier or an endpoint needs a secret. Strong
parts complete weak ones: ``access`` counts as identifier, ``assign`` and ``hex`` as secrets. A weak
part that overlaps a strong span adds nothing and is left out.

The scopes meet in an interval join: parts fall into cells of ``SCOPE`` characters, and cells are
joined by document and cell number. A cell can hold only so many parts, however long the document.

Defined cases: a NULL text is empty; a document without matches has zero counts and empty spans; each
row of a repeated document has its own result; positions count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.llm.common import table
from tidings.session import cut_lineage

SCOPE = 200  # characters
# The patterns of the strong kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"  # a maximal run is what [0-9a-f]+ matches
LEAST_VALUE, LEAST_ACCESS = 8, 16
# The weak parts.
IDENTIFIER = r"""((?i:client_?id|user_?name|account|login|access_?key(?:_?id)?|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{4,})"""
RUN = "[A-Za-z0-9+/_=-]"
SECRET = rf"(?<!{RUN})(?={RUN}*[0-9])(?={RUN}*[a-z])(?={RUN}*[A-Z]){RUN}{{24,}}+"
ENDPOINT = r"""(?:https?|ftp|jdbc:[a-z]+|amqps?|rediss?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?)://[^\x20\x09-\x0D"'<>]+"""

KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
STRONG = 3  # the first three
ROLE = ["secret", "identifier", "secret", "identifier", "secret", "endpoint"]  # of each kind
PATTERNS = [ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT]
VALUE_GROUP = [2, 0, 0, 2, 0, 0]


def _can_match(text: Column) -> list[Column]:
    """A cheap test for each kind: without these characters there is no match."""
    sign = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    return [sign, F.contains(text, F.lit("AKIA")), F.lit(True), sign, F.lit(True), F.contains(text, F.lit("://"))]


def _pieces(text: Column, kind: int, can_match: Column) -> Column:
    """Lengths of the gap before each match, of the match and of its value; the last gap has no match."""
    pattern = PATTERNS[kind]
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("len"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(VALUE_GROUP[kind])), F.length).alias("value"),
    )
    return F.when(can_match & F.rlike(text, F.lit(pattern)), zipped)


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: ``keep``, a row number and the match lengths per kind. Stored, without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tests = _can_match(text)
    found = [_pieces(text, k, tests[k]).alias(f"_k{k}") for k in range(len(KINDS))]
    return cut_lineage(docs.select(*keep, F.monotonically_increasing_id().alias("_row"), *found))


def all_spans(scanned: DataFrame) -> DataFrame:
    """Rows (_row, kind, start, end) of all parts, strong and weak, that pass their length tests."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_k{k}").alias("found")) for k in range(len(KINDS))])
    rows = scanned.where(F.coalesce(*[F.col(f"_k{k}") for k in range(len(KINDS))]).isNotNull())
    rows = rows.select("_row", F.explode(kinds).alias("one")).where(F.col("one.found").isNotNull())
    rows = rows.select("_row", F.col("one.kind").alias("kind"), F.posexplode("one.found").alias("pos", "m"))
    order = Window.partitionBy("_row", "kind").orderBy("pos")
    end = F.sum(F.col("m.gap") + F.coalesce(F.col("m.len"), F.lit(0))).over(order)
    placed = rows.withColumn("end", end).where(F.col("m.len").isNotNull())
    placed = placed.select("_row", "kind", (F.col("end") - F.col("m.len")).alias("start"), "end", F.col("m.value").alias("value"))
    short = ((F.col("kind") == 0) & (F.col("value") < LEAST_VALUE)) | ((F.col("kind") == 1) & (F.col("end") - F.col("start") < LEAST_ACCESS))
    return placed.where(~short).drop("value")


def linked_spans(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The strong spans, and the weak ones that a complementary part in their scope completes."""
    role = F.element_at(F.array(*map(F.lit, ROLE)), F.col("kind") + 1)
    parts = parts.withColumn("role", role)
    cell = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope))).alias("cell")
    weak = parts.where(F.col("kind") >= STRONG).select("*", cell(F.col("start") - scope, F.col("end") + scope)).alias("w")
    other = parts.select(F.col("_row").alias("o_row"), F.col("kind").alias("o_kind"), F.col("role").alias("o_role"),
                         F.col("start").alias("o_start"), F.col("end").alias("o_end"), cell(F.col("start"), F.col("end"))).alias("o")
    same = (F.col("w._row") == F.col("o.o_row")) & (F.col("w.cell") == F.col("o.cell"))
    apart = F.col("w.role") != F.col("o.o_role")
    complete = apart & ((F.col("w.role") == "secret") | (F.col("o.o_role") == "secret"))
    near = (F.col("o.o_start") <= F.col("w.end") + scope) & (F.col("o.o_end") >= F.col("w.start") - scope)
    overlap = (F.col("o.o_kind") < STRONG) & (F.col("o.o_start") < F.col("w.end")) & (F.col("o.o_end") > F.col("w.start"))
    names = ["_row", "kind", "start", "end"]
    completed = weak.join(other, same & complete & near & ~overlap, "left_semi").select(*names).distinct()
    doubled = weak.join(other, same & overlap, "left_semi").select(*names).distinct()
    kept = completed.join(doubled, names, "left_anti")
    return parts.where(F.col("kind") < STRONG).select(*names).unionByName(kept)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def summarise(scanned: DataFrame, spans: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: counts, the digest of the base spans, all spans."""
    grouped = spans.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("_spans"))
    some = F.coalesce(*[F.col(f"_k{k}") for k in range(len(KINDS))]).isNotNull()
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    with_parts = scanned.where(some).select(*keep, "_row").join(grouped, "_row", "left").withColumn("_spans", F.coalesce("_spans", nothing))
    rows = with_parts.select(*keep, "_spans").unionByName(scanned.where(~some).select(*keep, nothing.alias("_spans")))
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("_spans", lambda s: s["kind"] < STRONG)
    return rows.select(
        *keep, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every reported span replaced by ``mark``, all columns kept (n_chars follows).

    Documents without any part are passed on unmoved. The others meet their spans in a join by the
    digest of their text; a text that occurs in many rows is scanned once. A row travels as one
    struct, so no column name can clash with those used here.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    may = F.lit(False)
    for k, test in enumerate(_can_match(text)):
        may = may | (test & F.rlike(text, F.lit(PATTERNS[k])))
    held = docs.where(may).select(F.struct("*").alias("doc"), F.sha2(F.col("text"), 256).alias("digest"))
    texts = held.groupBy("digest").agg(F.first("doc.text").alias("text"))
    scanned = scan(texts, ["digest"])
    spans = linked_spans(all_spans(scanned)).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    edges = cut_lineage(scanned.select("digest", "_row").join(spans, "_row").select("digest", "spans"))
    joined = held.join(edges, "digest", "left").select("doc", F.col("doc.text").alias("text"), "spans")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def piece(low: Column, high: Column) -> Column:
        return F.substring(F.col("text"), (low + 1).cast("int"), (high - low).cast("int"))

    def step(state: Column, span: Column) -> Column:
        fresh = F.struct(span["end"].alias("at"), F.concat(state["out"], F.array(piece(state["at"], span["start"]), F.lit(mark))).alias("out"))
        wider = F.struct(F.greatest(state["at"], span["end"]).alias("at"), state["out"].alias("out"))  # begins inside the last one
        return F.when((span["start"] < state["at"]) & (F.size(state["out"]) > 0), wider).otherwise(fresh)

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), piece(state["at"], F.length("text").cast("long")))

    cleaned = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.aggregate("spans", begin, step, finish))
    changed = joined.select("doc", F.col("spans").isNotNull().alias("changed"), cleaned.alias("cleaned"))

    def column(name: str) -> Column:
        old = F.col("doc").getField(name)
        if name == "text":
            return F.col("cleaned").alias(name)
        if name == "n_chars":
            return F.when(F.col("changed"), F.length("cleaned").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return docs.where(~may).unionByName(changed.select(*[column(c) for c in docs.columns]))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])
    return summarise(scanned, linked_spans(all_spans(scanned)), ["doc_id"])

"""Secret scans over a content-addressed blob ledger.

Every version of every path is reduced to the SHA-256 of its content. A ledger
row says which rule versions have been run on a blob and what each of them found,
so a later scan touches only blobs, or rules, that the ledger has not seen, and
findings of rule versions that are no longer asked for stay out. Findings are
joined back to every path that holds the blob. All of it is built-in functions:
the text is never handed to Python.

A ledger is a Parquet table (blob, rules, spans). ``secret_report`` and ``redact``
take its path: what it has is joined, what was missing is appended. Without a path
the run starts a ledger of its own in the shared folder.

Defined cases: a null content is the empty text; an empty text has no findings;
equal rows stay separate rows of the result; a null path column is kept as it is;
ledger rows that occur twice count once; a missing or empty ledger has seen
nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path
from .names import unused


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Raise ``version`` when the pattern changes: its blobs are scanned anew.

    ``probe`` is a cheap pattern that every text with a finding must match.
    ``min_length`` holds for ``group`` of the pattern (0: the whole match).
    """

    kind: str
    version: int
    pattern: str
    min_length: int = 1
    group: int = 0
    probe: str | None = None

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign", 1,
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        12, 2, r"(?i:password|passwd|secret|token|api_?key)",
    ),
    # a match of [..]+ is a whole run of the class, so its least length can go into the pattern
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)

#: Kinds beyond the base ones; they only add spans.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", probe=r"-----BEGIN "),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", probe=r"eyJ[A-Za-z0-9_-]{8}"),
)

#: Setting of the session that names the ledger's folder.
LEDGER_SETTING = "reachmap.secrets.ledger"
LEDGER = "blob string, rules array<string>, spans array<struct<rule:string,start:int,end:int>>"
FOUND = "array<struct<rule:string,start:int,end:int>>"
SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int>>"
#: Matches of a text that are placed one after the other; runs of them are placed by the sums of the runs before.
RUN = 128


def rule_steps(text: Column, rule: Rule) -> Column:
    """Matches of one rule, leftmost first: the characters since the last one, its size, and whether it counts.

    ``split`` gives the gaps between the matches and ``regexp_extract_all`` the matches.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = (lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group))) if rule.group else F.length
    steps = F.zip_with(F.split(text, rule.pattern, -1), matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), (held(m) >= rule.min_length).alias("keep")))
    return F.when(text.rlike(rule.probe or rule.pattern), F.filter(steps, lambda x: x["size"].isNotNull()))


def placed_spans(steps: Column, rule: Rule, run: int = RUN) -> Column:
    """Spans of the steps that count, in code points, end exclusive.

    An array that grows by one element is copied each time; so runs of steps are
    summed first, and each run is placed from where it begins.
    """
    total, size = F.lit(0), F.coalesce(F.size(steps), F.lit(0))
    runs = F.when(size > 0, F.transform(F.sequence(F.lit(0), F.floor((size - 1) / run).cast("int")), lambda k: F.slice(steps, k * run + 1, F.lit(run)))).otherwise(F.array())
    sums = F.transform(runs, lambda r: F.aggregate(r, total, lambda acc, x: acc + x["gap"] + x["size"]))
    begins = F.aggregate(sums, F.array(total), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def place(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.array(F.struct(F.lit(rule.id).alias("rule"), begin.alias("start"), (begin + x["size"]).alias("end")))
        return F.struct((begin + x["size"]).alias("at"), F.when(x["keep"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    nothing = F.array().cast(FOUND)
    spans = F.zip_with(runs, F.slice(begins, F.lit(1), F.size(sums)), lambda r, at: F.aggregate(r, F.struct(at.alias("at"), nothing.alias("spans")), place, lambda acc: acc["spans"]))
    return F.when(size > 0, F.flatten(spans)).otherwise(nothing)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for blobs (blob, content, seen); ``seen``: rule ids to leave out."""
    steps = [F.when(~F.array_contains("seen", r.id), rule_steps(F.col("content"), r)).alias(f"steps_{i}") for i, r in enumerate(rules)]
    due = F.filter(F.array(*[F.lit(r.id) for r in rules]), lambda x: ~F.array_contains("seen", x))
    # two projections: each text is matched once, however often its steps are referred to
    stepped = blobs.select("blob", due.alias("rules"), *steps)
    return stepped.select("blob", "rules", F.concat(*[placed_spans(F.col(f"steps_{i}"), r) for i, r in enumerate(rules)]).alias("spans"))


def shown(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """Ledger spans as SPAN, sorted by start, then by the order of ``rules``."""
    ids, kinds = (F.array(*[F.lit(x) for x in column]) for column in zip(*((r.id, r.kind) for r in rules), strict=True))
    place = lambda s: F.array_position(ids, s["rule"]).cast("int")
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (place(s) - 1).alias("kind_no"), F.element_at(kinds, place(s)).alias("kind"), s["end"])).cast(SPAN))


def scan(versions: DataFrame, keys: list[str], content: str, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, spans_col: str = "spans", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Findings for every version row, and the rows this run adds to the ledger.

    ``versions`` has one row for each path and version; ``keys`` name the columns
    to return beside the findings. ``ledger`` has the rows (LEDGER) of former runs.
    Only blob and rule-version pairs that it lacks are scanned; they are written to
    ``path``, a new one by default. The first frame has keys and ``spans_col``,
    sorted by start, then by rule order.
    """
    spark, text = versions.sparkSession, F.coalesce(F.col(content), F.lit(""))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("content")).groupBy("blob").agg(F.first("content").alias("content"))
    ids = F.array(*[F.lit(r.id) for r in rules])
    if ledger is None:
        known = None
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        asked = ledger.select("blob", F.array_intersect("rules", ids).alias("rules"), F.filter("spans", lambda s: F.array_contains(ids, s["rule"])).alias("spans")).filter(F.size("rules") > 0)
        known = asked.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        blobs = blobs.join(known.select("blob", "seen"), "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>"))).filter(F.size(F.array_except(ids, F.col("seen"))) > 0)
    path = path or new_path(spark, "secret-ledger")
    scan_blobs(blobs, rules).write.option("compression", "zstd").parquet(path)
    added = spark.read.schema(LEDGER).parquet(path)
    found = added.select("blob", "spans").filter(F.size("spans") > 0)
    if known is not None:
        found = found.unionByName(known.select("blob", "spans").filter(F.size("spans") > 0)).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    blob_col, found_col = unused(keys, "blob"), unused(keys, "found")
    paths = versions.select(*[F.col(f"`{k}`") for k in keys], F.sha2(text, 256).alias(blob_col))
    joined = paths.join(found.select(F.col("blob").alias(blob_col), shown(F.col("spans"), rules).alias(found_col)), blob_col, "left")
    return joined.select(*[F.col(f"`{k}`") for k in keys], F.coalesce(found_col, F.array().cast(SPAN)).alias(spans_col)), added


def scan_with_ledger(versions: DataFrame, keys: list[str], content: str, path: str | None, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, spans_col: str = "spans") -> DataFrame:
    """The findings of ``scan`` with the ledger at ``path``, to which this run adds a folder with what it lacked."""
    spark = versions.sparkSession
    try:
        ledger = spark.read.schema(LEDGER).parquet(path) if path else None
    except AnalysisException:  # no ledger yet
        ledger = None
    return scan(versions, keys, content, ledger, rules, spans_col, f"{path}/run={uuid.uuid4().hex}" if path else None)[0]


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


#: Characters of the pieces that a text is cut into to find places in it.
PIECE = 4096


def reached(spans: Column, run: int = RUN) -> Column:
    """For each span the greatest end of those before it (0 for the first), and in the end that of all.

    Greatest ends of runs first, then within each run, as for ``placed_spans``.
    """
    # the slice is of the column itself: another array would be made anew for every run
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size(spans) / run).cast("int")), lambda k: F.transform(F.slice(spans, k * run + 1, F.lit(run)), lambda s: s["end"]))
    grown = lambda start, xs: F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), x))))
    before = grown(F.lit(0), F.transform(runs, lambda r: F.coalesce(F.array_max(r), F.lit(0))))
    # a run's last value is the next one's first, but for that of the last run
    within = F.zip_with(runs, F.slice(before, F.lit(1), F.size(runs)), lambda r, at: F.slice(grown(at, r), F.lit(1), F.size(r)))
    return F.concat(F.flatten(within), F.array(F.element_at(before, -1)))


def between(pieces: Column, begin: Column, end: Column) -> Column:
    """Characters from ``begin`` to ``end`` of a text cut into pieces of PIECE characters: only the pieces they are in are walked."""
    first, last = F.floor(begin / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    head = F.coalesce(F.get(pieces, first), F.lit(""))
    one = F.substring(head, begin - first * PIECE + 1, end - begin)
    middle = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    several = F.concat(F.substring(head, begin - first * PIECE + 1, F.lit(PIECE)), middle, F.substring(F.coalesce(F.get(pieces, last), F.lit("")), F.lit(1), end - last * PIECE))
    return F.when(end <= begin, "").when(first == last, one).otherwise(several)


def redacted(df: DataFrame, text_col: str, spans_col: str, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every stretch of the text that spans cover, alone or together, replaced by ``mark``; spans are sorted by start.

    The text between the covered stretches is taken from an array of pieces and joined
    once, so the work grows with the text and with the spans, not with their product.
    """
    pieces_col, ends_col = unused(df.columns, "pieces"), unused(df.columns, "ends")
    text, spans, pieces, ends = F.col(f"`{text_col}`"), F.col(f"`{spans_col}`"), F.col(pieces_col), F.col(ends_col)
    some = F.size(spans) > 0
    # projections of their own: each array is made once, however often it is referred to
    df = df.withColumns({pieces_col: F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))), ends_col: F.when(some, reached(spans))})
    fresh = F.filter(F.zip_with(spans, ends, lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"))), lambda x: x["start"] >= x["at"])
    parts = F.transform(fresh, lambda x: F.concat(between(pieces, x["at"], x["start"]), F.lit(mark)))
    rest = between(pieces, F.element_at(ends, -1), F.length(text))
    return df.withColumn(text_col, F.when(some, F.concat(F.array_join(parts, ""), rest)).otherwise(text)).drop(pieces_col, ends_col)


def may_match(text: Column, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> Column:
    """Whether a rule's cheap pattern is in the text: without it there is no finding."""
    return F.coalesce(reduce(or_, [text.rlike(r.probe or r.pattern) for r in rules]), F.lit(False))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None, ledger: str | None = None) -> DataFrame:
    """``docs`` with the secrets in ``text_col`` replaced, and ``length_col`` set to the new length where it was not null.

    Without a ledger to complete, rows that no rule can match go past the scan and its shuffles.
    """
    spans = unused(docs.columns, "spans")
    rows = docs if ledger else docs.filter(may_match(F.col(text_col)))
    hidden = redacted(scan_with_ledger(rows, docs.columns, text_col, ledger, spans_col=spans), text_col, spans)
    if length_col:
        hidden = hidden.withColumn(length_col, F.when((F.size(spans) > 0) & F.col(length_col).isNotNull(), F.length(text_col).cast(dict(docs.dtypes)[length_col])).otherwise(F.col(length_col)))
    hidden = hidden.select(*[F.col(f"`{c}`") for c in docs.columns])
    return hidden if ledger else docs.filter(~may_match(F.col(text_col))).unionByName(hidden)


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None) -> DataFrame:
    """Counts, digest and spans for each document."""
    found = scan_with_ledger(docs.select(id_col, text_col), [id_col], text_col, ledger)
    base = [r.kind for r in BASE_RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(spans_text(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op3_secret_scans(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """The report on documents; with ``ledger`` (a path, or else that in the session's LEDGER_SETTING) only what its former runs have not seen is scanned."""
    ledger = ledger or spark.conf.get(LEDGER_SETTING, None)
    return secret_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), ledger=ledger)


def _sql_spans(kind: str, no: int, pattern: str, keep: str) -> str:
    return f"""
  SELECT doc_id, {no} AS kind_no, '{kind}' AS kind, list_filter(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
      a := list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)::BIGINT,
      n := length(m[i])::BIGINT, k := {keep})), lambda s: s.k) AS found
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d)"""


_ASSIGN = r"(?:(?i)password|passwd|secret|token|api_?key(?-i))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join([
    _sql_spans("assign", 0, _ASSIGN + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(m[i], '^{_ASSIGN}', '')) >= 12"),
    _sql_spans("access", 1, "AKIA[A-Z0-9]{14,}", "true"),
    _sql_spans("hex", 2, "[0-9a-f]{16,}", "true"),
    _sql_spans("pem", 3, MORE_RULES[0].pattern, "true"),
    _sql_spans("jwt", 4, MORE_RULES[1].pattern, "true"),
])}),
s AS (SELECT doc_id, kind_no, kind, x.a AS a, x.a + x.n AS b FROM (SELECT doc_id, kind_no, kind, unnest(found) AS x FROM f)),
p AS (SELECT doc_id, count(*) FILTER (kind_no = 0) AS n0, count(*) FILTER (kind_no = 1) AS n1, count(*) FILTER (kind_no = 2) AS n2,
  string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, kind_no) FILTER (kind_no < 3) AS base,
  string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, kind_no) AS whole FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(whole, '') AS spans
FROM d LEFT JOIN p USING (doc_id)"""

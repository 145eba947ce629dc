"""Secret scans with an incremental blob ledger (operator 2); DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds
a row per blob and rule version with the spans found. A scan takes each distinct blob
once, looks up which rule versions the ledger already has for it, applies only the
others, and joins all findings back to every path that has the blob. ``Scan.entries``
are the new ledger rows, to be appended to the ledger that the next scan gets; ``scan_with_ledger``
keeps them in a folder. ``redact`` takes its spans from the same ledger.

Positions come from the pieces between the matches: a match begins after the pieces and
matches before it, counted in code points.

Defined cases: a null text is empty; an empty text has no findings; matches of a rule
don't overlap, those of different rules may; ties in start go by the rules' order;
copies and repeated rows share a blob and get the same findings; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.llm.shared import join_hot


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, in their order, and more kinds: private keys, tokens of forges, signed
# web tokens, passwords in addresses.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
_KEY = "[A-Z ]{0,32}PRIVATE KEY-----"
MORE_RULES = (
    # up to the END line, and where that is missing up to the end of the base64 lines
    Rule("pem", rf"-----BEGIN {_KEY}(?:[^-]*(?:-[^-]+){{0,64}}-----END {_KEY}|(?:\s+[A-Za-z0-9+/=]{{16,}})*)", version=2),
    Rule("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url", r"\b[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s:/@]{1,128}:([^\s:/@]{1,128})@", 1, 4),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<start:bigint,end:bigint>>"
ALL_SPANS = "array<struct<start:bigint,no:int,end:bigint,kind:string>>"


@dataclass(frozen=True)
class Scan:
    """``findings``: id, blob and spans of every row. ``entries``: new ledger rows."""

    findings: DataFrame
    entries: DataFrame


def spans_of(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text, in order: start and end in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    gaps = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(
        F.transform(matches, lambda m: F.length(m)).alias("size"),
        F.transform(checked, lambda m: F.length(m)).alias("checked"),
        F.transform(F.slice(gaps, 1, F.greatest(F.size(matches), F.lit(0))), lambda g: F.length(g)).alias("gap"),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("found"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + part["gap"]
        end = begin + part["size"]
        one = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(part["checked"] >= rule.least, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"),
        )

    none = F.array().cast(SPANS)
    return F.when(text.rlike(rule.pattern), F.aggregate(parts, start, step, lambda acc: acc["found"])).otherwise(none)


def blob_of(text: str = "text") -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


_ENTRIES = "array<struct<kind:string,rule_version:int,spans:array<struct<start:bigint,end:bigint>>>>"


def _entries(blobs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, text, known, fresh``: each blob's ledger entries under the rules' versions, and those that
    a scan of the others gives."""
    current = [r.key for r in rules]
    none = F.array().cast(_ENTRIES)
    if ledger is None:
        blobs = blobs.withColumn("known", none)
    else:
        of = ledger.where(F.concat_ws("@", "kind", F.col("rule_version").cast("string")).isin(current))
        # at most an entry per rule (a ledger that was appended twice has an entry twice)
        known = of.groupBy("blob").agg(F.collect_set(F.struct("kind", F.col("rule_version").cast("int"), "spans")).cast(_ENTRIES).alias("known"))
        blobs = blobs.join(known, "blob", "left").withColumn("known", F.coalesce("known", none))

    def has(r: Rule) -> Column:
        return F.exists("known", lambda e: (e["kind"] == r.kind) & (e["rule_version"] == r.version))

    fresh = F.array(
        *[
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("rule_version"),
                (spans_of(F.col("text"), r) if ledger is None else F.when(~has(r), spans_of(F.col("text"), r))).alias("spans"),
            )
            for r in rules
        ]
    )
    return blobs.withColumn("fresh", F.filter(fresh, lambda e: e["spans"].isNotNull()).cast(_ENTRIES))


def scan_blobs(blobs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, kind, rule_version, spans``: the blobs (``blob, text``, each once) under the rule versions
    that the ledger doesn't have for them."""
    return _entries(blobs.select("blob", "text"), ledger, rules).select("blob", F.inline("fresh"))


def scan(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Scan:
    """Scans every version (row) of ``docs`` that the ledger doesn't have yet."""
    texts = docs.select(
        F.col(id_col).alias(id_col), blob_of(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    entries = scan_blobs(texts.select("blob", "text").dropDuplicates(["blob"]), ledger, rules)
    found = spans_by_blob(entries if ledger is None else entries.unionByName(ledger.select(*entries.columns)), rules)
    findings = join_hot(texts.drop("text"), found, "blob", id_col)
    none = F.array().cast(ALL_SPANS)
    return Scan(findings.select(id_col, "blob", F.coalesce("spans", none).alias("spans")), entries)


def spans_by_blob(entries: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, spans``: the spans of the given rules in order of start and rule; only blobs that have any."""
    no = F.lit(None).cast("int")
    for k, r in enumerate(rules):
        no = F.when((F.col("kind") == r.kind) & (F.col("rule_version") == r.version), F.lit(k)).otherwise(no)
    entries = entries.where(F.size("spans") > 0).withColumn("no", no).where("no is not null")
    tagged = F.transform(
        "spans",
        lambda s: F.struct(s["start"].alias("start"), F.col("no"), s["end"].alias("end"), F.col("kind")),
    )
    # a ledger that was appended twice has an entry twice; at most a list per rule and blob
    lists = entries.select("blob", tagged.alias("spans")).groupBy("blob").agg(F.collect_set("spans").alias("spans"))
    return lists.select("blob", F.array_sort(F.flatten("spans")).cast(ALL_SPANS).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["no"] < len(BASE_RULES))
    numbers = F.transform("spans", lambda s: s["no"])
    counts = [
        F.size(F.array_compact(F.transform(numbers, lambda n: F.when(n == k, n)))).cast("long").alias(f"n_{r.kind}")
        for k, r in enumerate(BASE_RULES)
    ]
    return findings.select(
        id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], piece, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    whole = F.length(text)
    tail = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), whole))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, tail)).otherwise(text)


def redact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with the secrets in ``text_col`` replaced. The spans are those of the ledger's entries and,
    where it has none for a blob and rule version, of a scan; each blob is taken once and its clean text
    joined back to all rows that have it. A null text stays null. Columns of the names ``_blob``, ``_clean`` and
    ``_salt`` are in use here."""
    docs = docs.withColumn("_blob", blob_of(text_col))
    blobs = docs.select(F.col("_blob").alias("blob"), F.col(text_col).alias("text")).where("text is not null")
    found = _entries(blobs.dropDuplicates(["blob"]), ledger, rules)
    spans = F.array_sort(F.flatten(F.transform(F.concat("known", "fresh"), lambda e: e["spans"])))
    found = found.withColumn("spans", spans).where(F.size("spans") > 0)
    clean = found.select(F.col("blob").alias("_blob"), redacted(F.col("text"), F.col("spans")).alias("_clean"))
    joined = join_hot(docs, clean, "_blob", id_col).withColumn(text_col, F.coalesce("_clean", F.col(text_col)))
    return joined.drop("_blob", "_clean")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger kept in a folder of the shared storage; None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scan_with_ledger(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, **columns: str) -> DataFrame:
    """The findings of all rows of ``docs``; what the ledger in ``path`` lacks is scanned and appended to it."""
    spark = docs.sparkSession
    ledger = read_ledger(spark, path)
    scan(docs, ledger, rules, **columns).entries.write.mode("append").parquet(path)
    return scan(docs, read_ledger(spark, path), rules, **columns).findings


def oracle_sql() -> str:
    """The digests in DuckDB SQL."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    words = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    patterns = {
        "assign": "(" + words + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": BASE_RULES[1].pattern,
        "hex": BASE_RULES[2].pattern,
        **{r.kind: r.pattern for r in MORE_RULES},
    }
    scans = []
    for k, r in enumerate(RULES):
        p = patterns[r.kind]
        scans.append(f"""
  SELECT doc_id, {k} AS no, '{r.kind}' AS kind, row_id,
         unnest(list_transform(range(1, len(m) + 1), lambda i: {{
           's': coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
           'n': length(m[i]), 'v': length(v[i])}})) AS f
  FROM (SELECT doc_id, row_id, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS v,
               string_split_regex(t, '{p}') AS g FROM docs)""")
    union = "\n  UNION ALL".join(scans)
    least = " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(RULES))
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents),
found AS ({union}),
spans AS (SELECT row_id, no, kind, f.s::BIGINT AS s, (f.s + f.n)::BIGINT AS e,
                 kind || ':' || f.s::BIGINT || ':' || (f.s + f.n)::BIGINT AS name
          FROM found WHERE f.v >= CASE no {least} END),
folded AS (SELECT row_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access,
                  count(*) FILTER (no = 2) AS n_hex,
                  string_agg(name, ',' ORDER BY s, no) FILTER (no < 3) AS base,
                  string_agg(name, ',' ORDER BY s, no) AS spans
           FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN folded USING (row_id)
"""

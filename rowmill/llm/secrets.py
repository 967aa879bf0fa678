"""Secret scans with an incremental blob ledger.

Every version of every file or document is addressed by the SHA-256 of its content. The ledger, a
parquet table in a shared folder, holds one row per scan of a blob: which rule versions ran and what
they found. A scan reads the ledger, runs only the (blob, rule version) pairs that it lacks, appends
their findings, and joins the findings of the wanted rule versions back to all paths. Copies of a blob,
however many, are scanned once: they are dropped map-side before the shuffle by content address.

Rules are regular expressions; a finding is (kind, start, end) in code points, end exclusive. Within a
kind, matches are leftmost and do not overlap; kinds may overlap one another.

Defined cases: NULL content is empty and has no findings; empty tables give empty results; equal rows
give equal rows; every input column but the content is carried, one of a name that the result needs
(`blob`, `findings`) is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import with_columns
from rowmill.plans.storage import materialise


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    version: int = 1
    needs: str = ""  # a text that every match holds; it spares the pattern where absent
    matched: str = ""  # what is matched in place of pattern, if matches are dropped after they took their text
    least: int = 0  # the characters that group 1 of such a match needs

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Published shapes of credentials. The minimal lengths are part of the patterns: a
# match is always the whole run of its last class, so a run that is too short fails at every start.
# Not so for assign, as a value can hold a keyword: a short value is matched first and then dropped.
KEYWORDS = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
ASSIGN = rf"(?:{KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]"
BASE_RULES = (
    Rule("assign", f"{ASSIGN}{VALUE}{{12,}}", version=2, matched=f"{ASSIGN}({VALUE}+)", least=12),
    Rule("access", "AKIA[A-Z0-9]{14,}", needs="AKIA"),
    Rule("hex", "[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", "gh[opsru]_[A-Za-z0-9]{36,}", needs="gh"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", needs="eyJ"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{20,}", needs="xox"),
)
RULES = BASE_RULES + MORE_RULES

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, scanned array<string>, findings {FINDINGS}"


def located(text: Column, rule: Rule, hits: Column) -> Column:
    """The findings of a rule whose matched texts are known.

    The pieces between matches come from splitting at the rule; running lengths give the positions.
    """
    pattern = rule.matched or rule.pattern
    pieces = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FINDINGS).alias("found"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.char_length(pair["piece"])
        end = begin + F.char_length(pair["hit"])
        found = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end"))
        more = F.concat(state["found"], F.array(found))
        if rule.matched:
            long = F.char_length(F.regexp_extract(pair["hit"], pattern, 1)) >= rule.least
            more = F.when(long, more).otherwise(state["found"])
        return F.struct(end.alias("at"), more.alias("found"))

    pairs = F.zip_with(
        F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.struct(p.alias("piece"), h.alias("hit"))
    )
    return F.aggregate(pairs, start, step)["found"]


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Run each blob's missing rules; blobs: blob, content, seen (rule keys that already ran)."""
    none = F.array().cast(FINDINGS)
    hits, found = {}, []
    for i, r in enumerate(rules):
        due = ~F.array_contains("seen", r.key)
        if r.needs:
            due &= F.contains("content", F.lit(r.needs))
        hits[f"hits{i}"] = F.when(due, F.regexp_extract_all("content", F.lit(r.matched or r.pattern), 0))
        own = F.col(f"hits{i}")
        found.append(F.when(F.size(own) > 0, located(F.col("content"), r, own)).otherwise(none))
    keys = F.array(*[F.lit(r.key) for r in rules])
    return blobs.withColumns(hits).select(
        "blob", F.array_except(keys, "seen").alias("scanned"), F.concat(*found).alias("findings")
    )


def read_ledger(blobs: DataFrame, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None before the first scan."""
    spark = blobs.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not path.getFileSystem(conf).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_new(versions: DataFrame, ledger: str, content: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the pairs of blob and rule version that the ledger lacks, and add them to it."""
    text = F.coalesce(F.col(content), F.lit(""))
    known = read_ledger(versions, ledger)
    blobs = (
        versions.select(F.sha2(text, 256).alias("blob"), text.alias("content"))
        .groupBy("blob")
        .agg(F.first("content").alias("content"))
    )
    keys = F.array(*[F.lit(r.key) for r in rules])
    if known is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = known.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "seen", F.coalesce("seen", F.array().cast("array<string>"))
        )
    due = blobs.where(F.size(F.array_except(keys, "seen")) > 0)
    scan(due, rules).write.mode("append").parquet(ledger)


def scan_versions(
    versions: DataFrame, ledger: str, content: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Every row of versions with its blob and findings, scanning only what the ledger lacks."""
    scan_new(versions, ledger, content, rules)
    row = F.struct(*[F.col(c) for c in versions.columns if c != content] or [F.lit(1).alias("row")])
    text = F.coalesce(F.col(content), F.lit(""))
    # A blob can have several ledger rows, one for each time that rules were added.
    wanted = [(r.kind, r.key) for r in rules]
    current = F.filter(
        "findings",
        lambda f: F.lit(False) if not wanted else F.exists(
            F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("key")) for k, v in wanted]),
            lambda w: (w["kind"] == f["kind"]) & F.array_contains("scanned", w["key"]),
        ),
    )
    found = materialise(
        versions.sparkSession.read.schema(LEDGER)
        .parquet(ledger)
        .select("blob", current.alias("findings"))
        .where(F.size("findings") > 0)
        .groupBy("blob")
        # Scans at the same time, or one that was repeated, can leave a finding more than once.
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
    )
    # Written, so that both sides of this join are plain shuffles and a hot blob's paths can be split.
    paths = versions.select(row.alias("row"), F.sha2(text, 256).alias("blob"))
    joined = paths.join(found, "blob", "left")
    empty = F.array().cast(FINDINGS)
    return with_columns(
        joined, "row", {"blob": F.col("blob"), "findings": F.coalesce("findings", empty)}
    )


def report(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digests of findings per row: base kinds by name, then every span."""
    base = [r.kind for r in BASE_RULES]
    order = F.array(*[F.lit(r.kind) for r in rules])
    ranked = F.transform(
        "findings", lambda f: F.struct(f["start"], F.array_position(order, f["kind"]), f["kind"], f["end"])
    )
    spans = F.transform(
        F.array_sort(ranked),
        lambda f: F.struct(
            f["kind"].alias("kind"),
            F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")).alias("span"),
        ),
    )
    own = F.filter("_spans", lambda s: s["kind"].isin(base))
    number = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in base]
    text = lambda spans: F.array_join(F.transform(spans, lambda s: s["span"]), ",")
    return scanned.withColumn("_spans", spans).select(
        "doc_id", *counts, F.sha2(text(own), 256).alias("base_sha256"), text(F.col("_spans")).alias("spans")
    )

"""Secrets in whole texts, told apart by how widely their values are owned. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bind, column, documents, staged, text_or_empty, whole_row

#: Kinds in the order of the contract; ``owned`` is what the ownership frequency adds.
KINDS = ["assign", "access", "hex", "owned"]
#: Patterns of the contract (fixed values). A match of assign counts if its value has 6 characters or more.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: What the contract's patterns and lengths come to: a run is one match, and a shorter rest of it can't be long enough.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
#: Candidates beyond the base kinds: long runs of letters, digits and few signs; user and password in an address.
OPAQUE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{13,}"
LOGIN = "(?<=://)[A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%!$&'()*+,;=-]{6,}@"
MIN_VALUE = 6
#: Characters of an opaque run of letters and digits at least; digits of a payment card number.
OPAQUE_LENGTH, CARD = 16, (13, 19)
#: Owners, or repositories, from which a value counts as a widely copied example; repositories of its one owner that a
#: live value is in at most.
EXAMPLE_OWNERS, EXAMPLE_REPOS, LIVE_REPOS = 3, 5, 2
#: Bits a character that a live-looking value has at least, and share of its neighbours at most that count up, count down
#: or repeat.
ENTROPY, STEPS = 2.5, 0.5


def spans_of(text: Column, pattern: str, kind: str, keep=None, value=None) -> Column:
    """Every leftmost non-overlapping match of ``pattern`` as array<struct<start, end, kind, value>>, in code points.

    Matches and the pieces between them alternate, so the lengths of both, added up, are the positions.
    """

    def found(matches: Column, pieces: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("k"), F.array().cast("array<struct<start:bigint,end:bigint,kind:string,value:string>>").alias("out"))

        def step(acc: Column, match: Column) -> Column:
            begin = acc["at"] + F.length(F.get(pieces, acc["k"]))
            end = begin + F.length(match)
            one = F.array(F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), (value(match) if value else match).alias("value")))
            return F.struct(end.alias("at"), (acc["k"] + 1).alias("k"), F.concat(acc["out"], one).alias("out"))

        # concat copies what it has: runs of 64 matches keep that copying short
        def run(acc: Column, part: Column) -> Column:
            inner = F.aggregate(part, F.struct(acc["at"], acc["k"], start["out"].alias("out")), step)
            return F.struct(inner["at"].alias("at"), inner["k"].alias("k"), F.concat(acc["runs"], F.array(inner["out"])).alias("runs"))

        size = F.size(matches)
        runs = F.transform(F.sequence(F.lit(0), F.ceil(size / 64).cast("int") - 1), lambda k: F.slice(matches, k * 64 + 1, 64))
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("k"), F.array().cast("array<array<struct<start:bigint,end:bigint,kind:string,value:string>>>").alias("runs"))
        all_spans = F.flatten(F.aggregate(runs, zero, run, lambda acc: acc["runs"]))
        return all_spans if keep is None else F.filter(all_spans, keep)

    return bind(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda matches: F.when(F.size(matches) == 0, F.array().cast("array<struct<start:bigint,end:bigint,kind:string,value:string>>")).otherwise(
            bind(F.split(text, pattern), lambda pieces: found(matches, pieces))
        ),
    )


def passes_luhn(value: Column) -> Column:
    """Whether a run of digits has the check digit that payment cards have."""
    digit = lambda c, i: bind(c.cast("int") * (i % 2 + 1), lambda x: x - F.when(x > 9, 9).otherwise(0))
    total = F.aggregate(F.transform(F.split(F.reverse(value), ""), digit), F.lit(0), lambda acc, x: acc + x)
    return total % 10 == 0


def candidates(text: Column) -> Column:
    """Spans of the base kinds, then those of kind ``owned``, which are no more than candidates: opaque runs of letters
    and digits, card numbers whose check digit is right, logins in addresses."""
    long_value = lambda s: F.length(s["value"]) >= MIN_VALUE
    mixed = lambda v: (F.length(v) >= OPAQUE_LENGTH) & v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    card = lambda v: F.when(v.rlike("^[0-9]+$") & F.length(v).between(*CARD), passes_luhn(v)).otherwise(F.lit(False))
    return F.concat(
        spans_of(text, ASSIGN, "assign", long_value, lambda m: F.regexp_extract(m, ASSIGN, 2)),
        spans_of(text, ACCESS, "access"),
        spans_of(text, HEX, "hex"),
        spans_of(text, OPAQUE, "owned", lambda s: mixed(s["value"]) | card(s["value"])),
        spans_of(text, LOGIN, "owned", None, lambda m: F.regexp_extract(m, ":([^@]*)@", 1)),
    )


def ownership(spans: DataFrame) -> DataFrame:
    """hash, n_rows, n_named, n_repos, n_owners of ``spans`` (hash, owner, repo, named): in how many spans, base spans,
    repositories and owners a value occurs. Sums come before each shuffle, so a value that holds a third of all spans
    sends a few rows only."""
    by_repo = spans.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("named").cast("long")).alias("named"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.sum("named").alias("named"), F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_rows"), F.sum("named").alias("n_named"), F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def live_looking(value: Column) -> Column:
    """Long, with characters as mixed as in a random value, few of which count up, count down or repeat."""

    def random(chars: Column) -> Column:
        share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
        bits = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
        near = F.transform(F.sequence(F.lit(1), F.size(chars) - 1), lambda i: (F.abs(F.ascii(F.get(chars, i)) - F.ascii(F.get(chars, i - 1))) <= 1).cast("int"))
        steps = F.aggregate(near, F.lit(0), lambda acc, x: acc + x) / (F.size(chars) - 1)
        return (bits >= ENTROPY) & (steps <= STEPS)

    return F.when(F.length(value) >= CARD[0], bind(F.split(value, ""), random)).otherwise(F.lit(False))


def scan_columns(docs: DataFrame, owner: Column | None, repo: Column | None) -> list[Column]:
    """row_id, doc_id, owner, repo and candidate spans of each row. Columns that aren't there count as null, and a null
    owner or repository as one of its own."""
    there = lambda name: column(name) if name in docs.columns else F.lit(None).cast("string")
    owner = there("source") if owner is None else owner
    repo = F.concat_ws("/", there("source"), F.coalesce(there("lang"), F.lit("\0"))) if repo is None else repo
    return [
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(owner, F.lit("\0")).alias("owner"), F.coalesce(repo, F.lit("\0")).alias("repo"), candidates(text_or_empty()).alias("spans"),
    ]


def scanned(docs: DataFrame, owner: Column | None = None, repo: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, text, and what ``owner`` and ``repo`` read; by default source, and source with lang) to one row
    per row: row_id, doc_id, found.

    found: array<struct<start, rank, end, kind, value, verdict, n_owners, n_repos>> by start, then kind. verdict is
    ``example`` (the value occurs with ``EXAMPLE_OWNERS`` owners or in ``EXAMPLE_REPOS`` repositories, or more), ``live``
    (one owner only, in ``LIVE_REPOS`` repositories at most, and it looks live) or ``shared``. Base spans all stay,
    whatever their verdict. Of the candidates that touch no base span, those are added, as kind ``owned``, that are
    ``live``, and those whose value a base span names as a secret somewhere in the corpus, unless it is an ``example``.

    A null text has no spans. A null owner or repository counts as one of its own. Repeated rows are scanned each for
    itself; they count once for ownership, as their owner is the same. No rows give no rows.
    """
    return judged(staged(docs.select(*scan_columns(docs, owner, repo)), "spans"))


def judged(rows: DataFrame) -> DataFrame:
    """See ``scanned``; ``rows``: row_id, doc_id, owner, repo, spans."""
    each = rows.where(F.size("spans") > 0).select("row_id", "doc_id", "owner", "repo", F.explode("spans").alias("span"))
    each = each.withColumn("named", F.col("span.kind") != "owned")
    # a candidate touches a base span if one that starts before it ends after its start, or one starts before its end
    before = Window.partitionBy("row_id").orderBy("span.start", F.desc("named")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row_id").orderBy(F.desc("span.start"), F.desc("named")).rowsBetween(Window.unboundedPreceding, -1)
    base = lambda f, edge: f(F.when(F.col("named"), F.col(f"span.{edge}")))
    each = each.withColumns({"until": base(F.max, "end").over(before), "next": base(F.min, "start").over(after)})
    touches = F.coalesce(F.col("until") > F.col("span.start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("span.end"), F.lit(False))
    each = each.where(F.col("named") | ~touches).withColumn("hash", F.sha2("span.value", 256)).drop("until", "next")
    each = staged(each, "each")
    counts = staged(ownership(each).select("hash", "n_named", "n_repos", "n_owners"), "ownership")
    spread = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repos") >= EXAMPLE_REPOS)
    own = (F.col("n_owners") == 1) & (F.col("n_repos") <= LIVE_REPOS)
    verdict = F.when(spread, "example").when(own & live_looking(F.col("span.value")), "live").otherwise("shared")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("span.kind")).cast("int")
    told = F.struct("span.start", rank.alias("rank"), "span.end", "span.kind", "span.value", verdict.alias("verdict"), "n_owners", "n_repos")
    known = each.join(counts, "hash").select("row_id", "doc_id", "named", "n_named", told.alias("told"))
    known = known.where(F.col("named") | (F.col("told.verdict") == "live") | (F.col("n_named") > 0) & (F.col("told.verdict") != "example"))
    found = known.groupBy("row_id", "doc_id").agg(F.array_sort(F.collect_list("told")).alias("found"))
    # rows of which nothing is left: those without candidates, and those whose every candidate was dropped
    marked = rows.where(F.size("spans") > 0).select("row_id", "doc_id").join(found.drop("doc_id"), "row_id", "left")
    kind = found.schema["found"].dataType
    none = F.array().cast(kind)
    return marked.select("row_id", "doc_id", F.coalesce("found", none).alias("found")).unionByName(rows.where(F.size("spans") == 0).select("row_id", "doc_id", none.alias("found")))


def shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame, owner: Column | None = None, repo: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example of every row; see ``scanned``."""
    found = F.col("found")
    count = lambda test: F.size(F.filter(found, test)).cast("long")
    is_kind = lambda kind: lambda s: s["kind"] == kind
    return scanned(docs, owner, repo).select(
        "doc_id",
        *[count(is_kind(k)).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(shown(F.filter(found, lambda s: s["kind"] != "owned")), 256).alias("base_sha256"),
        shown(found).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "example").alias("n_example"),
    )


def redacted(docs: DataFrame, mask: str = "[SECRET]", owner: Column | None = None, repo: Column | None = None) -> DataFrame:
    """``docs`` with every span of theirs in text replaced by ``mask`` (overlapping ones by one) and n_chars, where that
    column is there, made to fit. Null texts stay null. Rows and other columns stay, whatever their names."""
    own = staged(docs.select(whole_row(docs.columns).alias("doc"), *scan_columns(docs, owner, repo)), "scanned")
    found = judged(own.select("row_id", "doc_id", "owner", "repo", "spans")).where(F.size("found") > 0)
    found = staged(found.select("row_id", "found"), "found")

    def joined(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        one = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(one)))

    merged = F.aggregate("found", F.array().cast("array<struct<start:bigint,end:bigint>>"), joined)
    starts = lambda m: F.concat(F.array(F.lit(0).cast("long")), F.transform(m, lambda s: s["end"]))
    ends = lambda m, chars: F.concat(F.transform(m, lambda s: s["start"]), F.array(F.size(chars).cast("long")))
    kept = lambda chars, m: F.zip_with(starts(m), ends(m, chars), lambda a, z: F.array_join(F.slice(chars, a.cast("int") + 1, (z - a).cast("int")), ""))
    text = F.col("doc")["text"]
    masked = bind(F.split(text, ""), lambda chars: bind(merged, lambda m: F.array_join(kept(chars, m), mask)))
    clean = F.when(F.col("found").isNull() | text.isNull(), text).otherwise(masked)
    rows = own.select("doc", "row_id").join(found, "row_id", "left").select("doc", "found", clean.alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("found").isNull(), F.col("doc")["n_chars"]).otherwise(F.length("clean")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; the owner is the source, a repository is a source's rows of one language."""
    return secret_spans(documents(spark, sf_dir))

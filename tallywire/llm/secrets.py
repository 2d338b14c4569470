"""Secret scans with corpus-wide ownership frequency, in built-in expressions alone.

Base spans come from three patterns over every whole text (null: empty), leftmost and non-overlapping per kind; matches
that are too short are dropped after matching:

* assign: a name such as `password` or `api_key`, an assignment sign, and a value of 12 or more characters,
* access: `AKIA` with capitals and digits, 18 or more characters in all,
* hex: 16 or more lower-case hexadecimal digits.

A span is the whole match, in code points, its end exclusive. Every value is then hashed, and for each hash the distinct
repositories and owners that hold it are counted over the corpus. A value that at least `EXAMPLE_OWNERS` owners have is
a widely copied example, any other looks live. The method adds spans of kind `token`: free-standing runs of 20 or more
letters, digits, `_` and `-` with capitals, small letters and digits among them that overlap no base span and look live.

An owner is by default the document's source and a repository the document; a null counts as one more owner or
repository. Rows that repeat an id are scanned each on its own; an empty table gives an empty result. Values meet
their counts in a join that Spark splits when one value is hot, and counts are partial aggregates. The work on a text
grows with its length and the sort of its spans, however many there are. Only hashes of values are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire.llm.common import stage

# The patterns of the base spans and of the added kind.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9_-]{20,}"

KINDS = ("assign", "access", "hex", "token")
TOKEN_KIND = 3
EXAMPLE_OWNERS = 3

_PIECES = "array<struct<kind:int,at:int,gap:int,size:int,hash:binary>>"


def _pieces(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """What one pattern cuts a text into: the gap before each match, its size, and the hash of its value if it counts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))

    def piece(part: Column, at: Column) -> Column:
        value = part["value"]
        ok = F.length(value) >= least
        if kind == TOKEN_KIND:
            ok = ok & value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")
        return F.struct(
            F.lit(kind).alias("kind"), at.alias("at"), F.length(part["gap"]).alias("gap"),
            F.coalesce(F.length(part["match"]), F.lit(0)).alias("size"), F.when(ok, F.unhex(F.sha2(value, 256))).alias("hash"),
        )

    return F.transform(cut, piece)


def scan(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, id, owner, repository and the pieces of every row of `docs`, stored."""
    none = F.array().cast(_PIECES)
    rows = docs.select(
        F.col(id_col).alias("id"), owner.alias("owner"), repository.alias("repository"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    small = F.lower("text")
    named = F.lit(False)
    for part in ("passw", "secret", "token", "apikey", "api_key"):
        named = named | F.contains(small, F.lit(part))
    plain = [
        (named, _pieces(F.col("text"), ASSIGN, 0, 2, 12)),
        (F.contains("text", F.lit("AKIA")), _pieces(F.col("text"), ACCESS, 1, 0, 18)),
        (F.col("text").rlike(HEX), _pieces(F.col("text"), HEX, 2, 0, 16)),
        (F.col("text").rlike(TOKEN), _pieces(F.col("text"), TOKEN, TOKEN_KIND, 0, 20)),
    ]
    pieces = F.concat(*[F.when(test, found).otherwise(none) for test, found in plain]).alias("pieces")
    found = rows.select("id", "owner", "repository", pieces)
    return stage(found.select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repository", "pieces"), "pieces")


def located(rows: DataFrame) -> DataFrame:
    """row, owner, repository, kind, start, end, hash of the base spans and of the tokens that overlap none of them.

    Places are running sums over the pieces of a text. A token is asked about at its end: of the base spans that start
    before it, the one that reaches farthest tells whether any overlaps. Both take a sort of the spans of a text.
    """
    cut = rows.select("row", "owner", "repository", F.explode("pieces").alias("p")).select("row", "owner", "repository", "p.*")
    cut = cut.repartition("row")
    along = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(along).cast("int")
    spans = cut.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).where("hash IS NOT NULL")
    token = F.col("kind") == TOKEN_KIND
    place = F.when(token, F.col("end")).otherwise(F.col("start"))
    before = Window.partitionBy("row").orderBy(place, F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.coalesce(F.max(F.when(~token, F.col("end"))).over(before), F.lit(0))
    free = spans.withColumn("reach", reach).where(~token | (F.col("reach") <= F.col("start")))
    return free.select("row", "owner", "repository", "kind", "start", "end", "hash")


def ownership(values: DataFrame) -> DataFrame:
    """hash, n_repositories, n_owners for every distinct value of `values` (hash, owner, repository)."""
    by_repository = values.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """id and spans (start, kind, end, n_repositories, n_owners, live) in order of start and kind, for every row."""
    owner = F.col("source") if owner is None else owner
    repository = F.col(id_col) if repository is None else repository
    rows = scan(docs, owner, repository, id_col, text_col)
    spans = stage(located(rows), "spans")
    counts = stage(ownership(spans), "ownership")
    live = F.col("n_owners") < example_owners
    judged = spans.join(counts, "hash").withColumn("live", live).where(live | (F.col("kind") < TOKEN_KIND))
    listed = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "n_repositories", "n_owners", "live"))).alias("spans")
    )
    empty = F.array().cast(listed.schema["spans"].dataType)
    return rows.select("row", "id").join(listed, "row", "left").select("id", F.coalesce("spans", empty).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")

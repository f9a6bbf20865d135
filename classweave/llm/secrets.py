"""Secret scans: spans that look like credentials, and how widely each one is owned."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classweave.llm.frames import columns, free_name, written

# The agreed patterns, the least number of characters, and the group that is counted.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    "access": (r"AKIA[A-Z0-9]+", 18, 0),
    "hex": (r"[0-9a-f]+", 16, 0),
}
# What stands between the lines of a key in a file, a literal or markup; a field such as DEK-Info; the lines themselves.
_GAP = r"""(?:\\+[nrt]|\\+u000[aAdD]|<[^<>]{0,20}>|&#?\w{1,8};|[\s"'`,;*#>|\\]|\+\s)*+"""
_FIELD = r"(?:[A-Z][A-Za-z-]{2,30}:[^\r\n\\]{0,200}+" + _GAP + ")*+"
_RUN = r"[A-Za-z0-9+/]{16,}+={0,2}"
_PEM_HEADER, _PEM_END = (rf"-----{word} [A-Z ]*PRIVATE KEY-----" for word in ("BEGIN", "END"))
#: A private key: header, body and END line. Without an END line the body is its run of base64, with the short line that may end it.
PEM = (
    rf"{_PEM_HEADER}(?:"
    rf"[A-Za-z0-9+/=\s\\\"']*+{_PEM_END}"
    rf"|(?={_GAP}{_FIELD}{_RUN})[^-]*+(?:-(?!----)[^-]*+)*+{_PEM_END}"
    rf"|{_GAP}{_FIELD}{_RUN}(?:{_GAP}{_RUN})*+(?:(?:\\+[nrt]|\s)++[A-Za-z0-9+/]++={{0,2}}(?=[\r\n\"'\\]|$))?)?"
)
#: What else may be a credential: taken only where its ownership says so.
CANDIDATES = {
    "issued": (r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})", 1, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 1, 0),
    "pem": (PEM, 1, 0),
}
KINDS = [*BASE, *CANDIDATES]
#: A credential that more owners or repositories than this carry is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 4

# Runs of hex digits are looked for by their least length: the same spans, found without stopping at every letter.
_SEARCH = {**{k: p for k, (p, _, _) in (BASE | CANDIDATES).items()}, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"(?<![0-9a-f])[0-9a-f]{16,}"}
#: What a text must contain for a span of each kind; in lower case where the pattern takes either.
_LOWER_PARTS = {"assign": ("passw", "secret", "token", "key")}
_PARTS = {"access": ("AKIA",), "issued": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "AIza"), "jwt": ("eyJ",), "pem": ("-----BEGIN ",)}


def _key_body(hit: Column) -> Column:
    """The base64 of a private key, however its lines are broken, quoted or indented; of a header alone, the header."""
    body = F.regexp_replace(hit, F.lit(rf"^{_PEM_HEADER}|{_PEM_END}$|\\+u000[aAdD]|\\+[nrt]|<[^<>]{{0,20}}>|&#?\w{{1,8}};"), F.lit(" "))
    body = F.regexp_replace(body, F.lit(r"\+(?=\s)|[^A-Za-z0-9+/=]+"), F.lit(""))
    return F.when(body == "", F.regexp_extract(hit, _PEM_HEADER, 0)).otherwise(body)


#: Running sums and maxima go over blocks of so many elements, and texts are cut into chunks of so many characters:
#: no array or text grows step by step, so the work is in proportion to a text's spans.
BLOCK, CHUNK = 64, 4096


def _bind(value: Column, use) -> Column:
    """`use(value)`, with `value` computed once: inside a function of array elements, an expression is computed for each."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, start: Column, merge, use) -> Column:
    """`use(before)`, where before(i) merges `start` and all `values` before place i (from 0).

    Each block of values is merged once, the blocks before a block are merged for it, and so is what lies in its block
    before a place.
    """

    def merged(part: Column) -> Column:
        return F.aggregate(part, start, merge)

    def with_values(own: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(own) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: merged(F.slice(own, b * BLOCK + 1, F.lit(BLOCK))))

        def with_sums(all_sums: Column) -> Column:
            bases = F.transform(all_sums, lambda _, b: merged(F.slice(all_sums, F.lit(1), b)))

            def with_bases(own_bases: Column) -> Column:
                def before(i: Column) -> Column:
                    block = F.floor(i / BLOCK).cast("int")
                    return F.aggregate(F.slice(own, block * BLOCK + 1, i - block * BLOCK), F.get(own_bases, block), merge)

                return use(before)

            return _bind(bases, with_bases)

        return _bind(sums, with_sums)

    return _bind(values, with_values)


def _kind_spans(text: Column, kind: str) -> Column:
    """array<struct<start, end, kind, value>>: the leftmost non-overlapping matches of one kind, in code points.

    Splitting at the pattern and extracting it walk the text alike, so lengths add up to positions.
    """
    _, least, group = (BASE | CANDIDATES)[kind]
    pattern = _SEARCH[kind]
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("gap"), whole.alias("hit"))

    def value(hit: Column) -> Column:
        return _key_body(hit) if kind == "pem" else F.regexp_extract(hit, pattern, group) if group else hit

    def spans(found: Column) -> Column:
        # The last gap has no match behind it; its length is not needed.
        steps = F.transform(found, lambda x: x["gap"] + F.coalesce(F.length(x["hit"]), F.lit(0)))

        def placed(before) -> Column:
            def span(x: Column, i: Column) -> Column:
                start = before(i) + x["gap"]
                return F.struct(start.alias("start"), (start + F.length(x["hit"])).alias("end"), F.lit(kind).alias("kind"), value(x["hit"]).alias("value"))

            return F.filter(F.transform(F.filter(found, lambda x: x["hit"].isNotNull()), span), lambda x: F.length(x["value"]) >= least)

        return _before(steps, F.lit(0), lambda a, b: a + b, placed)

    return _bind(pairs, spans)


def _may_hold(text: Column, kind: str) -> Column:
    """False for most texts without a span of this kind: a plain search, which costs a small part of the pattern's."""
    if kind == "hex":
        return text.rlike("[0-9a-f]{16}")
    if kind in _LOWER_PARTS:
        lowered = F.lower(text)
        return reduce(or_, [F.contains(lowered, F.lit(part)) for part in _LOWER_PARTS[kind]])
    return reduce(or_, [F.contains(text, F.lit(part)) for part in _PARTS[kind]])


def _ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"])
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), rank(x).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), x["value"].alias("value")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["value"].alias("value")))


def find_spans(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """`docs` with all base spans and candidates of each text, by start and kind, in a column `name`; null is an empty text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.expr("cast(array() AS array<struct<start:int,end:int,kind:string,value:string>>)")
    found = F.concat(*[F.when(_may_hold(text, k), _kind_spans(text, k)).otherwise(none) for k in KINDS])
    return docs.withColumn(name, F.when(any_part(text), _ordered(found)).otherwise(none))


def any_part(text: Column) -> Column:
    """False for most texts without any span."""
    return reduce(or_, [_may_hold(text, k) for k in KINDS])


def _hash(value: Column) -> Column:
    return F.sha2(value, 256)


def ownership(found: DataFrame, spans_col: str, owner: Column, repository: Column, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per distinct credential (its hash): how many owners, repositories and occurrences, and whether it looks live.

    The counts cover the whole corpus. They are combined within each task first, per credential, owner and repository,
    so a credential in a third of all rows is a few rows after that.
    """
    each = found.where(F.size(spans_col) > 0).select(owner.alias("owner"), repository.alias("repository"), F.explode(spans_col).alias("x"))
    each = each.select(_hash(F.col("x.value")).alias("credential"), "owner", "repository")
    pairs = each.groupBy("credential", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = pairs.groupBy("credential", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    out = per_owner.groupBy("credential").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("occurrences"))
    return out.withColumn("live", (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))


def scan_secrets(
    docs: DataFrame,
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """All columns of `docs`, and behind them its secrets.

    New columns (with underscores appended where `docs` has the name): spans, array of (start, end, kind, value, owners,
    repositories, live) by start and kind, in code points; n_live and n_example, long. A base span always stays; a
    candidate stays only where few owners and repositories carry it, since a widely copied one is a documentation
    example. A private key reaches from its header to its END line, and its body is the value that owners are counted by.
    Owners default to the column `source`, repositories to `source` and `lang`; a null counts as an owner of its own. A
    null or empty text has no spans; repeated rows are scanned one by one and count once per repository. Texts of any
    length take time in proportion to their length and spans. Documents without a span are not shuffled.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.struct("source", "lang") if repository is None else repository
    names = {n: free_name(docs.columns, n) for n in ("spans", "n_live", "n_example")}
    raw, key = (free_name([*docs.columns, *names.values()], n) for n in ("_raw", "_key"))
    may = any_part(F.coalesce(F.col(text_col), F.lit("")))
    # Patterns run once over each text that a plain search lets through; those rows are written with their spans.
    searched = written(find_spans(docs.where(may), text_col, raw), "secrets")
    held = searched.where(F.size(raw) > 0).withColumn(key, F.sha2(F.to_json(raw), 256))
    credentials = ownership(held, raw, owner, repository, max_owners, max_repositories).drop("occurrences")

    # What a document's spans look up, once for each distinct list of spans: its credentials, joined and put back in order.
    lists = held.select(F.col(key).alias("id"), F.col(raw).alias("list")).groupBy("id").agg(F.any_value("list").alias("list"))
    looked = lists.select("id", F.posexplode("list").alias("at", "x")).withColumn("credential", _hash(F.col("x.value")))
    base = F.array(*[F.lit(k) for k in BASE])
    found = looked.join(credentials, "credential").where(F.array_contains(base, F.col("x.kind")) | F.col("live"))
    row = F.struct("at", "x", "owners", "repositories", "live")
    judged = found.groupBy("id").agg(F.array_sort(F.collect_list(row)).alias("all"))
    full = lambda s: F.struct(*[s["x"][n].alias(n) for n in ("start", "end", "kind", "value")], *[s[n].alias(n) for n in ("owners", "repositories", "live")])
    own_key = free_name([*docs.columns, *names.values(), raw, key], "_id")
    judged = judged.select(F.col("id").alias(own_key), F.transform("all", full).alias(names["spans"]))
    counts = lambda live: F.size(F.filter(F.col(names["spans"]), lambda x: x["live"] == live)).cast("long")

    empty = F.expr("cast(array() AS array<struct<start:int,end:int,kind:string,value:string,owners:bigint,repositories:bigint,live:boolean>>)")
    # A list of copied examples only has no row left.
    with_spans = held.join(judged, F.col(key) == F.col(own_key), "left").withColumn(names["spans"], F.coalesce(F.col(names["spans"]), empty))
    without = [rows.withColumn(names["spans"], empty) for rows in (searched.where(F.size(raw) == 0), docs.where(~may))]
    parts = [rows.select(*columns(docs.columns), names["spans"]) for rows in (with_spans, *without)]
    out = reduce(DataFrame.unionAll, parts)
    return out.withColumn(names["n_live"], counts(True)).withColumn(names["n_example"], counts(False))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[{}]", **options) -> DataFrame:
    """`docs` with every span of `scan_secrets` replaced by its kind in brackets; overlapping spans become one. Same columns."""
    scanned = scan_secrets(docs, text_col, **options)
    spans = [c for c in scanned.columns if c not in docs.columns][0]
    first, last = mark.split("{}")

    def replaced(text: Column) -> Column:
        def cut(chunks: Column, start: Column, end: Column) -> Column:
            """Characters `start` to `end` of the text, from the chunks that hold them."""
            chunk = F.floor(start / CHUNK).cast("int")
            inside = F.array_join(F.slice(chunks, chunk + 1, F.floor(end / CHUNK).cast("int") - chunk + 1), "")
            return F.when(end > start, F.substring(inside, start - chunk * CHUNK + 1, end - start)).otherwise("")

        def pieces(chunks: Column) -> Column:
            def joined(before) -> Column:
                def piece(x: Column, i: Column) -> Column:
                    whole = F.concat(cut(chunks, before(i), x["start"]), F.lit(first), x["kind"], F.lit(last))
                    return F.when(x["start"] >= before(i), whole).otherwise("")

                tail = cut(chunks, before(F.size(spans)), F.length(text))
                return F.concat(F.array_join(F.transform(F.col(spans), piece), ""), tail)

            return _before(F.transform(F.col(spans), lambda x: x["end"]), F.lit(0), lambda a, b: F.greatest(a, b), joined)

        starts = F.sequence(F.lit(0), F.floor(F.length(text) / CHUNK).cast("int"))
        return _bind(F.transform(starts, lambda k: F.substring(text, k * CHUNK + 1, F.lit(CHUNK))), pieces)

    done = replaced(F.coalesce(F.col(text_col), F.lit("")))
    clean = F.when(F.size(spans) > 0, done).otherwise(F.col(text_col)).alias(text_col)
    return scanned.select(*[clean if c == text_col else x for c, x in zip(docs.columns, columns(docs.columns))])


def spans_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

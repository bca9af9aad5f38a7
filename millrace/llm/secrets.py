"""Secrets in text, by DataFrame functions only: fixed patterns and a battery of randomness tests.

Base patterns give spans of kind ``assign``, ``access`` and ``hex``. Besides, every run of encoded characters
is a candidate: its encoding is inferred (the smallest alphabet that holds it), and three tests ask whether it
could be random in that alphabet: chi-squared uniformity (of symbols and, for short runs, of quarters of the
alphabet), runs above and below the middle, and serial
correlation. Candidates that pass become spans of kind ``random`` if they survive a false-discovery control:
the p-value of a candidate is the probability that ordinary text of its length and alphabet is spread so
evenly, and Benjamini-Hochberg runs within classes of length, so that short candidates, which ordinary words
imitate easily, do not use up the error that long ones are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import saved, whole_row

# The base patterns and what must be as long as stated.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

# Alphabets in the order in which they are tried.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: A run of encoded characters below this length is not tested: it could not be told from a word.
LEAST_LENGTH = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}" % LEAST_LENGTH
#: No alphabet has signs of both kinds, as runs in addresses and paths do: those are tested in parts, for either kind.
MIXED = r"[+/].*[_-]|[_-].*[+/]"
PARTS = tuple(r"[A-Za-z0-9%s]{%d,}" % (signs, LEAST_LENGTH) for signs in ("+/", "_-"))
#: Lower bounds of the classes of length.
LENGTH_CLASSES = (20, 24, 32, 48, 96, 192)
#: Chi-squared with six degrees of freedom at one per cent: beyond it a candidate is not random.
NOT_RANDOM = 16.812
FALSE_DISCOVERIES = 0.01
#: The repeat rate of letters in ordinary text, used where the corpus has no candidate of letters only.
ORDINARY_REPEATS = 0.066
#: p-values are counted in bins of a quarter of a decade, the last open.
BINS, BIN_WIDTH = 80, 0.25
_BLOCK = 256


def _prefix_sums(values: Column) -> Column:
    """Running sums in blocks, so that a text of very many matches does not take quadratic time."""
    count = F.size(values)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    none = F.array().cast("array<int>")
    sums = F.transform(
        blocks,
        lambda block: F.aggregate(
            block, none, lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))))
        ),
    )
    before = F.aggregate(
        blocks,
        F.array(F.lit(0)),
        lambda acc, block: F.concat(
            acc, F.array(F.element_at(acc, -1) + F.aggregate(block, F.lit(0), lambda total, x: total + x))
        ),
    )
    # The last entry of ``before`` is the total and meets no block.
    joined = F.zip_with(sums, before, lambda block, start: F.transform(F.coalesce(block, none), lambda x: x + start))
    return F.when(count > 0, F.flatten(joined)).otherwise(none)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """All matches in order: (start, end, group), offsets in code points."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(whole, F.length)
    between = F.transform(F.split(text, pattern, -1), F.length)
    advance = F.zip_with(
        F.slice(between, F.lit(1), F.size(lengths)),
        F.concat(F.array(F.lit(0)), lengths),
        lambda gap, match: gap + match,
    )
    starts = _prefix_sums(F.slice(advance, F.lit(1), F.size(lengths)))
    parts = F.arrays_zip(
        starts.alias("start"), lengths.alias("n"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part")
    )
    found = F.transform(
        parts,
        lambda p: F.struct(
            p["start"].alias("start"), (p["start"] + p["n"]).alias("end"), p["part"].alias("part")
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,end:int,part:string>>"))


def _candidates(runs: Column) -> Column:
    """The runs, and in place of a run with signs of both kinds its parts of one kind, some of which overlap."""

    def parts(run: Column) -> Column:
        found = [_matches(run["part"], pattern, 0) for pattern in PARTS]
        moved = F.transform(
            F.concat(*found),
            lambda m: F.struct((run["start"] + m["start"]).alias("start"), (run["start"] + m["end"]).alias("end"), m["part"].alias("part")),
        )
        return F.array_distinct(moved)

    return F.flatten(F.transform(runs, lambda run: F.when(run["part"].rlike(MIXED), parts(run)).otherwise(F.array(run))))


def _kept(found: str, kind: str, least: int) -> Column:
    return F.transform(
        F.filter(found, lambda m: F.length(m["part"]) >= least),
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")),
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _symbols(candidate: Column) -> Column:
    """(start, end, alphabet's size, symbol numbers, letters only) of a candidate in its smallest alphabet."""
    part = candidate["part"]
    name = F.lit(None).cast("string")
    for key, alphabet in reversed(list(ALPHABETS.items())):
        name = F.when(part.rlike(f"^[{alphabet.replace('-', chr(92) + '-')}]+$"), F.lit(key)).otherwise(name)
    letters = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    return F.struct(
        candidate["start"].alias("start"),
        candidate["end"].alias("end"),
        part.rlike("^[A-Za-z]+$").alias("plain"),
        letters[name].alias("alphabet"),
        part.alias("part"),
    )


def _numbered(candidate: Column) -> Column:
    alphabet = candidate["alphabet"]
    return F.struct(
        candidate["start"].alias("start"),
        candidate["end"].alias("end"),
        candidate["plain"].alias("plain"),
        F.length(alphabet).cast("double").alias("a"),
        F.transform(F.split(candidate["part"], ""), lambda c: F.instr(alphabet, c).cast("double")).alias("v"),
    )


def _moments(candidate: Column) -> Column:
    """Sums from which the three statistics follow."""
    v, a = candidate["v"], candidate["a"]
    mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)
    return F.struct(
        *[candidate[k].alias(k) for k in ("start", "end", "plain", "a", "v")],
        F.size(v).cast("double").alias("n"),
        mean.alias("mean"),
        F.aggregate(
            F.sequence(F.lit(1), a.cast("int")),
            F.lit(0.0),
            lambda s, k: s + F.pow(F.size(F.filter(v, lambda x: x == k)).cast("double"), F.lit(2.0)),
        ).alias("squares"),
        F.size(F.filter(v, lambda x: x > a / 2)).cast("double").alias("high"),
    )


def _counter(from_: Column, to: Column):
    return lambda count, x: count + ((x > from_) & (x <= to)).cast("double")


def _statistics(candidate: Column) -> Column:
    v, a, n, mean, high = (candidate[k] for k in ("v", "a", "n", "mean", "high"))
    low = n - high
    chi = candidate["squares"] * a / n - n
    z_chi = F.greatest((chi - (a - 1)) / F.sqrt(2 * (a - 1) * (1 - 1 / n)), F.lit(0.0))
    after = F.slice(v, F.lit(2), F.size(v) - 1)
    before = F.slice(v, F.lit(1), F.size(v) - 1)
    changes = F.aggregate(
        F.zip_with(before, after, lambda x, y: ((x > a / 2) != (y > a / 2)).cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    pairs = 2 * high * low
    spread = F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * (n - 1)), F.lit(1e-9)))
    quarters = F.lit(0.0)
    for k in range(4):
        from_, to = a * k / 4, a * (k + 1) / 4
        inside = F.aggregate(v, F.lit(0.0), _counter(from_, to))
        # How many symbols the quarter has: not all alphabets can be divided by four.
        share = (F.floor(a * (k + 1) / 4) - F.floor(a * k / 4)) / a
        quarters = quarters + (inside - n * share) * (inside - n * share) / (n * share)
    z_runs = F.when(pairs == 0, F.lit(99.0)).otherwise((changes + 1 - (pairs / n + 1)) / spread)
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    products = F.aggregate(
        F.zip_with(before, after, lambda x, y: (x - mean) * (y - mean)), F.lit(0.0), lambda s, x: s + x
    )
    z_serial = F.when(square == 0, F.lit(99.0)).otherwise((products / square + 1 / (n - 1)) * F.sqrt(n))
    return F.struct(
        candidate["start"].alias("start"),
        candidate["end"].alias("end"),
        candidate["plain"].alias("plain"),
        a.alias("a"),
        n.alias("n"),
        chi.alias("chi"),
        (z_chi * z_chi + quarters + z_runs * z_runs + z_serial * z_serial).alias("departure"),
        ((candidate["squares"] - n) / (n * (n - 1))).alias("repeats"),
    )


def _normal_tail(z: Column) -> Column:
    """-log10 of the standard normal distribution function at z (a tight bound for negative z)."""
    below = z * z / (2 * 2.302585092994046) + F.log10(F.greatest(-z, F.lit(1.0)) * 2.5066282746310002)
    return F.when(z < -1, below).otherwise(F.lit(0.0))


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for k, least in enumerate(LENGTH_CLASSES):
        out = F.when(n >= least, F.lit(k)).otherwise(out)
    return out


def _evidence(candidate: Column, repeats: Column) -> Column:
    """-log10 p: how unlikely ordinary text with this rate of repeats is to be spread so evenly."""
    a, n = candidate["a"], candidate["n"]
    excess = F.greatest(a * repeats - 1, F.lit(0.2)) * (n - 1)
    z = (candidate["chi"] - (a - 1) - excess) / F.sqrt(2 * (a - 1) + 4 * excess)
    return F.when(candidate["departure"] <= NOT_RANDOM, _normal_tail(z)).otherwise(F.lit(0.0))


def _bin(evidence: Column) -> Column:
    return F.least(F.floor(evidence / BIN_WIDTH), F.lit(BINS - 1)).cast("int")


def scan(docs: DataFrame, text: str = "text", false_discoveries: float = FALSE_DISCOVERIES) -> DataFrame:
    """Every row of ``docs`` (all its columns but the text) with ``base_spans`` and ``spans``.

    Spans are structs (start, kind as a place in ``KINDS``, end) in code points, end exclusive. A null text is
    empty and has none; repeated rows are scanned each for itself; an empty table gives an empty one. The
    input's columns must not be called ``base_spans`` or ``spans``: such columns are replaced. Columns are
    named with a leading ``_secret`` meanwhile.
    """
    rest = [c for c in docs.columns if c not in (text, "base_spans", "spans")]
    t = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        *[F.col(f"`{c}`") for c in rest],
        _matches(t, ASSIGN, 2).alias("_secret_assign"),
        _matches(t, ACCESS, 0).alias("_secret_access"),
        _matches(t, HEX, 0).alias("_secret_hex"),
        _matches(t, CANDIDATE, 0).alias("_secret_runs"),
    )
    tested = F.transform(
        F.filter(F.transform(_candidates(F.col("_secret_runs")), _symbols), lambda c: c["alphabet"].isNotNull()), _numbered
    )
    first = saved(
        found.select(
            *[F.col(f"`{c}`") for c in rest],
            F.concat(_kept("_secret_assign", "assign", 8), _kept("_secret_access", "access", 16), _kept("_secret_hex", "hex", 32)).alias("base_spans"),
            F.transform(F.transform(tested, _moments), _statistics).alias("_secret_tested"),
        ),
        "secrets",
    )
    # One row of sums, then at most classes x bins rows of counts: bounded at any size of the corpus.
    each = first.select(F.explode("_secret_tested").alias("c"))
    repeats = each.select(
        F.coalesce(F.avg(F.when(F.col("c.plain"), F.col("c.repeats"))), F.lit(ORDINARY_REPEATS)).alias("r")
    ).first()["r"]
    strength = _bin(_evidence(F.col("c"), F.lit(repeats)))
    counts = each.groupBy(_length_class(F.col("c.n")).alias("k"), strength.alias("b")).count().collect()
    least = [BINS + 1] * len(LENGTH_CLASSES)
    for k in range(len(LENGTH_CLASSES)):
        by_bin = {r["b"]: r["count"] for r in counts if r["k"] == k}
        total, above = sum(by_bin.values()), 0
        for b in range(BINS - 1, 0, -1):
            above += by_bin.get(b, 0)
            if above and total * 10 ** (-b * BIN_WIDTH) <= false_discoveries * above:
                least[k] = b
    limits = F.array(*[F.lit(x) for x in least])
    discovered = F.filter(
        "_secret_tested", lambda c: _bin(_evidence(c, F.lit(repeats))) >= limits[_length_class(c["n"])]
    )
    extra = F.transform(
        discovered,
        lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), c["end"].alias("end")),
    )
    return first.select(
        *[F.col(f"`{c}`") for c in rest], "base_spans", F.concat("base_spans", extra).alias("spans")
    )


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _running_max(values: Column) -> Column:
    """For each value the largest of those before it, 0 for the first, in blocks as :func:`_prefix_sums`."""
    count = F.size(values)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    none = F.array().cast("array<int>")
    largest = F.transform(
        blocks,
        # One entry more than the block has values: what comes after its last one.
        lambda block: F.aggregate(block, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.greatest(x, F.element_at(acc, -1))))),
    )
    before = F.aggregate(
        largest, F.array(F.lit(0)), lambda acc, block: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), F.element_at(block, -1))))
    )
    joined = F.zip_with(
        largest,
        before,
        lambda block, start: F.transform(F.slice(F.coalesce(block, none), F.lit(1), F.greatest(F.size(block) - 1, F.lit(0))), lambda x: F.greatest(x, start)),
    )
    return F.when(count > 0, F.flatten(joined)).otherwise(none)


def _masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark in place of each run of overlapping spans; spans are in order.

    The text is cut as UTF-32, where a place is found at once: substrings of a text would be counted from its start.
    """
    wide = F.encode(text, "UTF-32")
    reached = _running_max(F.transform(spans, lambda s: s["end"]))
    gaps = F.filter(
        F.zip_with(spans, reached, lambda s, r: F.struct(r.alias("from"), s["start"].alias("to"))), lambda gap: gap["to"] >= gap["from"]
    )
    kept = F.transform(gaps, lambda gap: F.decode(F.substring(wide, 4 * gap["from"] + 1, 4 * (gap["to"] - gap["from"])), "UTF-32"))
    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    tail = F.decode(F.substring(wide, 4 * end + 1, F.octet_length(wide)), "UTF-32")
    return F.array_join(F.concat(kept, F.array(tail)), mark)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All rows of ``docs`` with ``mark`` in place of every span (overlapping ones together).

    All other columns stay as they are, whatever they are called. ``n_chars``, where there is such a column, is the
    length of the new text. A null text stays null; repeated rows are treated alike.
    """
    scanned = scan(docs.select(whole_row(docs), F.col("text")))
    text, found = F.col("row")["text"], F.size("spans") > 0
    scanned = scanned.withColumn("clean", F.when(found, _masked(text, F.sort_array("spans"), mark)).otherwise(text))
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("clean")
        elif c == "n_chars":
            value = F.when(found, F.length("clean").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return scanned.select(*columns)

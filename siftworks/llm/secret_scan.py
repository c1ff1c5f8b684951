"""Secret scan with SQL functions only: fixed patterns, and a battery of randomness tests on other token-like strings.

Every token of 20 or more characters that mixes digits with letters gets an encoding (hex, base32, base36, base64) from its characters.
Three tests ask whether it is random in that alphabet: chi-squared uniformity, runs above and below the middle, and the
correlation of neighbours. The smallest of the three p-values (times three) is the token's. A token is dismissed as not
random where its p-value is among those that Benjamini-Hochberg rejects in its length class; the rest are secrets of
kind ``random``. The procedure works on counts per class and p-value bin (a bounded table), so it is one aggregate at any size.

Defined cases. Null text: as empty, no spans. Positions are code points, end exclusive. Equal rows get equal results; the
p-values of all rows count, repeated ones included. A random span that meets a base span is left out. Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import fresh, kept_table

# Fixed values of the contract.
KINDS = ("assign", "access", "hex", "random")
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + "([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
FEWEST_ASSIGN, FEWEST_ACCESS, FEWEST_HEX = 6, 20, 24

TOKEN = "[A-Za-z0-9+/_-]{20,}"
# Alphabets by encoding, in the order in which a token is tried.
HEX_LOWER, HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36_LOWER, BASE36_UPPER = "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
FALSE_DISCOVERY = 0.01
BINS_PER_DECADE, LAST_BIN, LAST_CLASS = 20, 600, 14
CHUNK = 64
MARK = "[SECRET]"


def let(value: Column, body) -> Column:
    """Bind a value to a lambda variable, so that it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, value) of the leftmost non-overlapping matches.

    The text is cut at the matches; lengths of pieces and matches add up to positions, in chunks, so that texts with very
    many matches stay linear.
    """
    def place(pieces: Column, hits: Column) -> Column:
        sizes = F.arrays_zip(F.transform(pieces, F.char_length).alias("gap"), F.transform(hits, F.char_length).alias("len"), hits.alias("value"))
        number = F.size(hits)
        chunks = F.transform(F.sequence(F.lit(0), F.floor((number - 1) / CHUNK).cast("int")), lambda c: F.slice(sizes, c * CHUNK + 1, F.least(F.lit(CHUNK), number - c * CHUNK)))
        length = lambda part: F.aggregate(part, F.lit(0), lambda a, s: a + s["gap"] + s["len"])
        empty = F.array().cast("array<struct<base:int,part:array<struct<gap:int,len:int,value:string>>>>")
        based = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), empty.alias("out")),
                            lambda a, part: F.struct((a["at"] + length(part)).alias("at"),
                                                     F.concat(a["out"], F.array(F.struct(a["at"].alias("base"), part.alias("part")))).alias("out")))["out"]
        none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

        def within(c: Column) -> Column:
            step = lambda a, s: F.struct(
                (a["at"] + s["gap"] + s["len"]).alias("at"),
                F.concat(a["out"], F.array(F.struct((a["at"] + s["gap"]).alias("start"), F.lit(kind).alias("kind"),
                                                    (a["at"] + s["gap"] + s["len"]).alias("end"), s["value"].alias("value")))).alias("out"))
            return F.aggregate(c["part"], F.struct(c["base"].alias("at"), none.alias("out")), step)["out"]

        return F.flatten(F.transform(based, within))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda hits: F.when(F.size(hits) > 0, let(F.slice(F.split(text, pattern, -1), 1, F.size(hits)), lambda pieces: place(pieces, hits))))
    return F.coalesce(F.when(text.rlike(pattern), found), F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns that are long enough."""
    assign = F.when(text.rlike(ASSIGN_HEAD), F.filter(spans(text, ASSIGN, 0), lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 1)) >= FEWEST_ASSIGN))
    access = F.when(F.contains(text, F.lit("AKIA")), F.filter(spans(text, ACCESS, 1), lambda s: F.char_length(s["value"]) >= FEWEST_ACCESS))
    # Only whole runs match, so the short ones may be left out of the pattern: the same matches, without one entry per short run.
    hexes = spans(text, "[0-9a-f]{%d,}" % FEWEST_HEX, 2)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.concat(F.coalesce(assign, none), F.coalesce(access, none), hexes)


def alphabet(token: Column) -> Column:
    """The smallest alphabet that holds the token; null for tokens without a digit or without a letter."""
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
    return F.when(mixed, F.when(token.rlike("^[0-9a-f]+$"), HEX_LOWER).when(token.rlike("^[0-9A-F]+$"), HEX_UPPER)
                  .when(token.rlike("^[A-Z2-7]+$"), BASE32).when(token.rlike("^[0-9a-z]+$"), BASE36_LOWER)
                  .when(token.rlike("^[0-9A-Z]+$"), BASE36_UPPER).otherwise(BASE64))


def upper_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (polynomial approximation, error below 1e-7 in absolute terms)."""
    def of(x: Column) -> Column:
        tail = let(1 / (1 + 0.2316419 * F.abs(x)), lambda t: F.exp(-x * x / 2) / 2.5066282746310002 * t * (
            0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))))
        return let(tail, lambda q: F.when(x >= 0, q).otherwise(1 - q))
    return let(z, of)


def p_value(token: Column) -> Column:
    """Combined p-value of the battery under the hypothesis that the token is random; null without an alphabet."""
    zero = F.lit(0.0)
    total = lambda items, value=lambda k: k: F.aggregate(items, zero, lambda a, k: a + value(k))
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)

    def chi_squared(v: Column, size: Column, n: Column) -> Column:
        squares = total(F.array_distinct(v), lambda k: F.pow(F.size(F.filter(v, lambda w: w == k)).cast("double"), F.lit(2.0)))
        cube = F.pow(F.greatest(size / n * squares - n, zero) / (size - 1), F.lit(1.0 / 3))
        return let(2 / (9 * (size - 1)), lambda spread: (cube - (1 - spread)) / F.sqrt(spread))

    def runs(v: Column, half: Column, n: Column) -> Column:
        changes = total(F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda a, b: flag((a > half) != (b > half))))
        return let(total(v, lambda k: flag(k > half)), lambda above: F.when((above > 0) & (above < n), let(
            2 * above * (n - above) / n + 1, lambda mean: F.abs(1 + changes - mean) / F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))))))

    def serial(v: Column, n: Column) -> Column:
        return let(total(v) / n, lambda mean: let(F.transform(v, lambda k: k - mean), lambda d: F.abs(
            total(F.zip_with(F.slice(d, 1, F.size(d) - 1), F.slice(d, 2, F.size(d) - 1), lambda a, b: a * b))
            / F.greatest(total(d, lambda k: k * k), F.lit(1e-9)) + 1 / n) * F.sqrt(n)))

    def tests(v: Column, size: Column, n: Column) -> Column:
        of_runs = let(runs(v, size / 2, n), lambda z: F.when(z.isNull(), zero).otherwise(2 * upper_tail(z)))
        return F.least(F.lit(1.0), F.greatest(zero, 3 * F.least(upper_tail(chi_squared(v, size, n)), of_runs, 2 * upper_tail(serial(v, n)))))

    def battery(letters: Column) -> Column:
        places = F.transform(F.regexp_extract_all(token, F.lit("."), F.lit(0)), lambda c: F.instr(letters, c).cast("double"))
        return let(F.struct(places.alias("v"), F.char_length(letters).cast("double").alias("size"), F.char_length(token).cast("double").alias("n")),
                   lambda s: tests(s["v"], s["size"], s["n"]))

    return let(alphabet(token), lambda letters: F.when(letters.isNotNull(), battery(letters)))


def length_class(token: Column) -> Column:
    return F.least(F.floor(F.log2(F.char_length(token))).cast("int"), F.lit(LAST_CLASS))


def p_bin(p: Column) -> Column:
    return F.least(F.lit(LAST_BIN), F.floor(-F.log10(F.greatest(p, F.lit(1e-40))) * BINS_PER_DECADE)).cast("int")


def candidates(text: Column) -> Column:
    """Token-like strings with their length class and p-value bin."""
    tokens = F.filter(spans(text, TOKEN, 3), lambda s: alphabet(s["value"]).isNotNull())
    return F.transform(tokens, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
                                                  length_class(s["value"]).alias("class"), p_bin(p_value(s["value"])).alias("bin")))


def cuts(tokens: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[int, int]:
    """For each length class the first bin that is rejected as not random (tokens: class, bin). At most 15 times 601 counts."""
    found: dict[int, int] = {}
    counts: dict[int, dict[int, int]] = {}
    for row in tokens.groupBy("class", "bin").count().collect():
        counts.setdefault(row["class"], {})[row["bin"]] = row["count"]
    for name, bins in counts.items():
        total, tail, first = sum(bins.values()), 0, LAST_BIN + 1
        for b in sorted(bins, reverse=True):
            tail += bins[b]
            if 10 ** (-b / BINS_PER_DECADE) <= rate * tail / total:
                first = b
        found[name] = first
    return found


def _chosen(tokens: Column, base: Column, first: dict[int, int]) -> Column:
    if not first:
        return F.array().cast("array<struct<start:int,kind:int,end:int>>")
    table = F.create_map(*[F.lit(x) for pair in sorted(first.items()) for x in pair])
    random = F.filter(tokens, lambda s: (s["bin"] < F.element_at(table, s["class"])) & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.transform(random, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def scanned(docs: DataFrame) -> DataFrame:
    """Narrow table (doc_id, base, tokens) from one pass over the texts, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", base_spans(text).alias("base"), candidates(text).alias("tokens"))
    bare = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return kept_table(found.select("doc_id", bare.alias("base"), F.transform("tokens", lambda s: s.dropFields("value")).alias("tokens")), "secrets")


def learned_cuts(table: DataFrame) -> dict[int, int]:
    return cuts(table.where(F.size("tokens") > 0).select(F.inline("tokens")).select("class", "bin"))


def _joined(items: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(items), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) for every document."""
    table = scanned(docs)
    first = learned_cuts(table)
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    random = _chosen(F.col("tokens"), F.col("base"), first)
    return table.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.size(random).cast("long").alias("n_random"),
                        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.concat("base", random)).alias("spans"))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by a mark; ``n_chars``, where present, follows the text.

    The spans of ``secret_scan`` go whole; of a labelled value the label stays. Base spans go first, so that no other replacement
    breaks them; an access key goes with the hexadecimal digits that follow it, as the two may overlap. Then each token that is
    left is tested where it stands.
    """
    first = learned_cuts(scanned(docs))
    plain = fresh(docs, "plain_text")[0]
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "(%s)[A-Za-z0-9+/_.=-]{%d,}" % (ASSIGN_HEAD, FEWEST_ASSIGN), "$1" + MARK)
    text = F.regexp_replace(text, "AKIA[A-Z0-9]{%d,}[0-9a-f]*|[0-9a-f]{%d,}" % (FEWEST_ACCESS - 4, FEWEST_HEX), MARK)
    found = docs.withColumn(plain, text)
    if first:
        table = F.create_map(*[F.lit(x) for pair in sorted(first.items()) for x in pair])
        secret = lambda t: alphabet(t).isNotNull() & (p_bin(p_value(t)) < F.element_at(table, length_class(t)))
        pieces = lambda hits: F.zip_with(F.split(F.col(plain), TOKEN, -1), hits, lambda gap, token: F.concat(
            gap, F.when(token.isNull(), F.lit("")).when(secret(token), F.lit(MARK)).otherwise(token)))
        cut = let(F.regexp_extract_all(F.col(plain), F.lit(TOKEN), F.lit(0)), lambda hits: F.array_join(pieces(hits), ""))
        found = found.withColumn(plain, F.when(F.col(plain).rlike(TOKEN), cut).otherwise(F.col(plain)))
    out = found.withColumn("text", F.when(F.col("text").isNotNull(), F.col(plain)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

"""Text assembly, cleaning and phrase matching as column expressions.

Three matching dialects are kept apart on purpose, because the rule sets were
written for different ones:

* substring: ``has_any`` / ``first_term`` / ``matched_terms``
* whole word around a literal phrase: ``has_phrase`` / ``phrase_regex``
* alphanumeric look-around with flexible spaces: ``token_terms``

All tests start with ``contains`` (a byte search) so the regular expression is
only run on rows that can match.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce
from html.entities import html5
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

def no() -> Column:
    return F.lit(False)


def field(df: DataFrame, name: str) -> Column:
    """The column as text, or '' when the table does not have it."""
    if name not in df.columns:
        return F.lit("")
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def flag(df: DataFrame, name: str) -> Column:
    """The column as a boolean, false when missing or null."""
    if name not in df.columns:
        return no()
    return F.coalesce(F.col(name).cast("boolean"), no())


def nz(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A column expression is a tree: using a long one in several places repeats it,
    and nested uses multiply.  Binding it to a lambda variable keeps the plan small.
    """
    return F.get(F.transform(F.array(value), body), 0)


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) columns so that they are computed exactly once.

    Columns of a plain projection are copied into every later filter and
    projection that uses them.  A generator that yields one row keeps long
    expressions in one place, for the optimizer and at run time.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    computed = df.select(*kept, *[value.alias(f"_settle_{name}") for name, value in columns.items()])
    row = F.struct(*[F.col(f"_settle_{name}").alias(name) for name in columns])
    return computed.select(*kept, F.inline(F.array(row)))


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def first_filled(*values: Column) -> Column:
    """First non-empty text, '' when all are empty."""
    return F.coalesce(*[blank_to_null(v) for v in values], F.lit(""))


def join_fields(df: DataFrame, names: Iterable[str], lower: bool = True) -> Column:
    """Fields separated by one space; empty fields keep their separator."""
    joined = F.concat_ws(" ", *[field(df, name) for name in names])
    return F.lower(joined) if lower else joined


def squeeze(value: Column) -> Column:
    """Collapse Unicode white space to single spaces and trim."""
    return F.trim(F.regexp_replace(nz(value), r"(?U)\s+", " "))


# The characters with the Unicode property White_Space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_space(value: Column) -> Column:
    """Trim Unicode white space at both ends; a pattern would be tried at every character in between."""
    return F.trim(nz(value), F.lit(SPACES))


def strip_long(text: Column) -> Column:
    """:func:`strip_space` of a long text that is a column: its ends are looked at first, as trimming walks through the whole text."""
    ends = [F.contains(F.lit(SPACES), F.substring(text, at, 1)) for at in (1, -1)]
    return F.when(reduce(or_, ends), strip_space(text)).otherwise(nz(text))


def profile_text(value: Column) -> Column:
    """Lower case, punctuation to spaces, one space between words.

    The words are taken and joined: a negated class that holds letters beyond ASCII
    costs the regular expressions of Java many times as much per character.
    """
    return F.array_join(F.regexp_extract_all(F.lower(nz(value)), F.lit("[a-z0-9àèéìòù]+"), F.lit(0)), " ")


def profile_term(term: str) -> str:
    """The same normalisation for a rule term (driver side, one short string)."""
    return re.sub(r"[^a-z0-9àèéìòù]+", " ", str(term).lower()).strip()


# --- substring dialect ------------------------------------------------------

class LongText:
    """A long lower-case text that is searched once for all terms of a rule book.

    ``found`` tells for each of the terms whether the text holds it.  Texts that are
    joined from this one and short ones around it (:class:`Joined`) are then decided by
    ``found`` and by the short ones with the ends of the long one.
    """

    def __init__(self, terms: Iterable[str], name: str):
        self.terms = list(dict.fromkeys(terms))
        self.gap = next(c for c in map(chr, range(0x110000)) if not any(c in t for t in self.terms))  # no term is found across it
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.text, self.ends, self.found = f"_{name}_low", f"_{name}_ends", f"_{name}_found"
        self.columns = (self.text, self.ends, self.found)
        # Terms that hold no other term are looked for in every text; the others only where the longest such term in them was found.
        self.roots = [t for t in self.terms if not any(o in t for o in self.terms if o != t)]

    def _search(self, df: DataFrame, text: Column) -> DataFrame:
        # One test over an array of constants: written out per term, the code of a row grows too long to be compiled.
        roots = F.array(*[F.lit(t) for t in self.roots]).cast("array<string>")
        df = settle(df, {f"{self.found}_roots": F.transform(roots, lambda t: F.contains(text, t))})
        root = {t: F.get(F.col(f"{self.found}_roots"), F.lit(i)) for i, t in enumerate(self.roots)}

        def found(term: str) -> Column:
            if term in root:
                return root[term]
            return F.when(root[max((t for t in root if t in term), key=len)], F.contains(text, F.lit(term))).otherwise(no())

        return settle(df, {self.found: F.array(*[found(t) for t in self.terms]).cast("array<boolean>")}).drop(f"{self.found}_roots")

    def add(self, df: DataFrame, value: Column) -> DataFrame:
        """Add the lower-case text, its ends and what it holds; what is there is not added again."""
        low = df if self.text in df.columns else settle(df, {self.text: F.lower(nz(value))})
        if self.found in df.columns:
            return low
        width = max(map(len, self.terms), default=0)
        text = F.col(self.text)
        cut = F.concat(F.substring(text, 1, width), F.lit(self.gap), F.substring(text, -width, width)) if width else F.lit(self.gap)
        return self._search(settle(low, {self.ends: F.when(F.length(text) <= 2 * width, text).otherwise(cut)}), text)


class Joined:
    """Lower-case texts joined by one space, one of them a :class:`LongText`: ``before``, it, ``after``."""

    def __init__(self, long: LongText, before: Sequence[Column] = (), after: Sequence[Column] = (), rest: str | None = None):
        """``rest`` names a settled column of :meth:`short`."""
        self.long, self.before, self.after, self.rest = long, list(before), list(after), rest

    def _around(self, middle: str) -> Column:
        low = lambda values: [F.lower(nz(v)) for v in values]
        return F.concat_ws(" ", *low(self.before), F.col(middle), *low(self.after))

    def short(self) -> Column:
        """The short texts and the ends of the long one: all terms that the long text does not hold alone lie here."""
        return self._around(self.long.ends)

    def whole(self) -> Column:
        return self._around(self.long.text)

    def holds(self, term: str) -> Column:
        if term not in self.long.place:
            return F.contains(self.whole(), F.lit(term))
        alone = F.get(F.col(self.long.found), F.lit(self.long.place[term]))
        if not self.before and not self.after:
            return alone
        return alone | F.contains(self.short() if self.rest is None else F.col(self.rest), F.lit(term))


def rarest_word(term: str) -> str:
    """The word of a profile term that is looked for first: the longest one."""
    return max(term.split(" "), key=len)


class Profile:
    """The profile form (:func:`profile_text`) of a joined text, without building it.

    A word lies in it when the text holds the word. Several words do when the text holds
    them with anything but letters of words in between.
    """

    def __init__(self, text: Joined):
        self.text = text

    def holds(self, term: str) -> Column:
        words = term.split(" ")
        if len(words) == 1:
            return self.text.holds(term)
        near = self.text.whole().rlike("[^a-z0-9àèéìòù]+".join(map(re.escape, words)))
        return self.text.holds(rarest_word(term)) & near


def holds(text: Column | Joined | Profile, term: str) -> Column:
    return F.contains(text, F.lit(term)) if isinstance(text, Column) else text.holds(term)


def has_any(text: Column | Joined | Profile, terms: Sequence[str]) -> Column:
    return reduce(or_, [holds(text, t) for t in terms], no())


def first_term(text: Column | Joined | Profile, terms: Sequence[str]) -> Column:
    """First term (in rule order) contained in the text, else null."""
    if not terms:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(holds(text, t), F.lit(t)) for t in terms])


def matched_terms(text: Column, terms: Sequence[str]) -> Column:
    if not terms:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in terms]))


def first_label(text: Column, labelled, otherwise: str | Column) -> Column:
    """Label of the first rule with a matching term."""
    default = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    if not labelled:
        return default
    return F.coalesce(*[F.when(has_any(text, terms), F.lit(label)) for label, terms in labelled], default)


def group_points(text: Column, groups) -> Column:
    """Sum of the points of all groups with a matching term."""
    return reduce(
        lambda total, group: total + F.when(has_any(text, group[0]), group[1]).otherwise(0),
        groups,
        F.lit(0),
    )


# --- whole-word dialect -----------------------------------------------------

def phrase_regex(phrase: str) -> str:
    return r"(?U)\b" + re.escape(phrase.lower()) + r"\b"


def has_word(text: Column, phrase: str) -> Column:
    return F.contains(text, F.lit(phrase.lower())) & text.rlike(phrase_regex(phrase))


def has_phrase(text: Column, phrases: Sequence[str]) -> Column:
    return reduce(or_, [has_word(text, p) for p in phrases], no())


def all_phrases(text: Column, phrases: Sequence[str]) -> Column:
    return reduce(and_, [has_word(text, p) for p in phrases])


WORD_GAP = r"(?U)\W+"


def phrase_words(phrase: str) -> list[str]:
    """Words of a phrase (driver side, one short string)."""
    return [word for word in re.split(r"\W+", phrase.lower()) if word]


def find_phrases(df: DataFrame, text: str, phrases: Sequence[str], name: str) -> DataFrame:
    """Add an array column with the whole-word phrases of a lower-case text column.

    The text is cut into words once and met with the vocabulary of all phrases.
    Each phrase stands in an index under its rarest word, so only the phrases of
    the words that occur are looked at, however many there are.  A one-word
    phrase is then decided; a longer one is searched for only where all its
    words occur.
    """
    phrases = [p.lower() for p in phrases]
    rules = [{
        "phrase": p, "words": phrase_words(p), "rx": phrase_regex(p), "exact": phrase_words(p) == [p],
    } for p in phrases]
    uses = Counter(word for rule in rules for word in set(rule["words"]))
    for rule in rules:  # a phrase without words stands under "", which every text is asked for
        rule["key"] = min(rule["words"], key=lambda word: (uses[word], -len(word), word), default="")
    words = F.array_intersect(literal_rows(sorted(uses), "array<string>"), F.split(F.col(text), WORD_GAP))
    found = settle(df, {"_words": words})
    keys = F.array_append(F.col("_words"), F.lit("")) if any(not rule["words"] for rule in rules) else F.col("_words")
    hits = F.filter(indexed(keys, rules, "phrase:string,words:array<string>,rx:string,exact:boolean"), lambda r: r["exact"] | (
        F.forall(r["words"], lambda word: F.array_contains(F.col("_words"), word))
        & F.contains(F.col(text), r["phrase"]) & F.rlike(F.col(text), r["rx"])))
    return settle(found, {name: F.transform(hits, lambda r: r["phrase"])}).drop("_words")


def indexed(keys: Column, rows: Sequence[dict], fields: str) -> Column:
    """The rule rows whose ``key`` is among the distinct ``keys``, in rule order; no keys (null) give none.

    Rows lie in as many slots as there are rows, by a hash of their key, so a key
    costs one look into an array of constants and not a walk over all rules.
    """
    slots = 1 << max(len(rows) - 1, 1).bit_length()
    table = [[] for _ in range(slots)]
    for at, row in enumerate(rows):
        table[zlib.crc32(row["key"].encode()) % slots].append({"at": at, **row})
    schema = f"struct<at:int,key:string,{fields}>"
    index = literal_rows(table, f"array<array<{schema}>>")

    def of(key: Column) -> Column:
        slot = (F.crc32(key.cast("binary")) % slots).cast("int") + 1
        return F.filter(F.element_at(index, slot), lambda row: row["key"] == key)

    return F.coalesce(F.sort_array(F.flatten(F.transform(keys, of))), F.array().cast(f"array<{schema}>"))


def literal_rows(rows: list, schema: str) -> Column:
    """Rule rows as one constant (folded at planning time)."""
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), schema)


# --- look-around dialect ----------------------------------------------------

def token_match(text: Column, term: str) -> Column:
    """Term between non-alphanumerics; its spaces match any white space."""
    term = term.lower()
    if re.match(r"[a-z0-9]", term) and re.search(r"[a-z0-9]$", term):
        words = [re.escape(word) for word in term.split(" ")]
        probe = max(term.split(" "), key=len)
        pattern = r"(?<![a-z0-9])" + r"(?U:\s+)".join(words) + r"(?![a-z0-9])"
        return F.contains(text, F.lit(probe)) & text.rlike(pattern)
    return F.contains(text, F.lit(term))


def token_terms(text: Column, terms: Sequence[str]) -> Column:
    """Matching terms in rule order; the text must be lower case."""
    if not terms:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(token_match(text, t), F.lit(t.lower())) for t in terms]))


def has_token(text: Column, terms: Sequence[str]) -> Column:
    return reduce(or_, [token_match(text, t) for t in terms], no())


def first_token_label(text: Column, labelled, otherwise: str) -> Column:
    return F.coalesce(*[F.when(has_token(text, terms), F.lit(label)) for label, terms in labelled], F.lit(otherwise))


# --- markup -----------------------------------------------------------------

# Named character references: the standard library's table of HTML5. Names that may stand without a semicolon are matched longest first.
NAMED = json.dumps({f"&{name}": character for name, character in html5.items()})
BARE = "|".join(sorted((re.escape(name) for name in html5 if not name.endswith(";")), key=len, reverse=True))
REFERENCE = rf"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;|(?:{BARE}))"
# Code points 128 to 159 are read as windows-1252, where it has a character.
REMAPPED = json.dumps({str(c): bytes([c]).decode("cp1252") for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)})


def _table(values: str) -> Column:
    """A constant map, handed over as one JSON literal."""
    return F.from_json(F.lit(values), F.lit("map<string,string>"))


def _numeric_character(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "^&#[xX]?([0-9A-Fa-f]+)", 1)
    is_hex = F.lower(F.substring(reference, 3, 1)) == "x"
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    code = F.when(F.length(short) > 7, F.lit(0x110000)).otherwise(
        F.when(is_hex, F.conv(short, 16, 10).cast("int")).otherwise(short.cast("int")))

    def character(code: Column) -> Column:
        bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        gone = code.between(1, 8) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
        # UTF-8 bytes of the code point, built with integer arithmetic.
        tail = lambda shift: F.lit(0x80) + F.shiftright(code, shift).bitwiseAND(F.lit(0x3F))
        as_hex = lambda *parts: F.concat(*[F.lpad(F.hex(p), 2, "0") for p in parts])
        encoded = (
            F.when(code < 0x80, as_hex(code))
            .when(code < 0x800, as_hex(F.lit(0xC0) + F.shiftright(code, 6), tail(0)))
            .when(code < 0x10000, as_hex(F.lit(0xE0) + F.shiftright(code, 12), tail(6), tail(0)))
            .otherwise(as_hex(F.lit(0xF0) + F.shiftright(code, 18), tail(12), tail(6), tail(0)))
        )
        mapped = F.when(code.between(0x80, 0x9F), F.element_at(_table(REMAPPED), code.cast("string")))
        return F.when(bad, F.lit("\ufffd")).when(gone, F.lit("")).otherwise(F.coalesce(mapped, F.decode(F.unhex(encoded), "UTF-8")))

    return let(code, character)


def _character(reference: Column) -> Column:
    """What one reference stands for; unknown names stay, known beginnings of them are decoded."""
    bare = F.regexp_extract(reference, f"^&(?:{BARE})", 0)
    named = F.coalesce(
        F.element_at(_table(NAMED), reference),
        F.when(bare != "", F.concat(F.element_at(_table(NAMED), bare), F.substr(reference, F.length(bare) + 1))), reference)
    return F.when(F.startswith(reference, F.lit("&#")), _numeric_character(reference)).otherwise(named)


def unescape(value: Column) -> Column:
    """Decode the character references of HTML5 in one pass, so that nothing is decoded twice.

    The text is cut at its references; each distinct one is decoded once.
    """
    def replaced(text: Column) -> Column:
        def woven(parts: Column) -> Column:
            names = F.array_distinct(parts["hits"])
            known = F.map_from_arrays(names, F.transform(names, _character))
            return let(known, lambda table: F.concat(
                F.array_join(F.zip_with(F.slice(parts["gaps"], 1, F.size(parts["hits"])), parts["hits"], lambda g, h: F.concat(g, F.element_at(table, h))), ""),
                F.element_at(parts["gaps"], -1)))

        return let(F.struct(F.split(text, REFERENCE, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)).alias("hits")), woven)

    return let(nz(value), lambda text: F.when(text.rlike(REFERENCE), replaced(text)).otherwise(text))


def drop_tags(value: Column) -> Column:
    return F.regexp_replace(nz(value), r"<[^>]+>", " ")


def plain_text(value: Column) -> Column:
    """Tags out, character references decoded, white space collapsed."""
    return squeeze(unescape(drop_tags(value)))


def visible_text(html: Column) -> Column:
    """Readable text of a page: no scripts or styles, blocks end with '. '."""
    text = F.regexp_replace(nz(html), r"(?is)<script\b.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style\b.*?</style>", " ")
    text = F.regexp_replace(text, r"(?i)</(?:p|div|li|section|article|h[1-6])>", ". ")
    return plain_text(text)


def extract_text(html: Column, pattern: str) -> Column:
    """First capture group of a pattern, as plain text; '' without a match."""
    return plain_text(F.regexp_extract(nz(html), pattern, 1))


def label_value(text: Column, labels: Sequence[str]) -> Column:
    """Value after 'Label:' up to the next label, a double space or the end; cut at '. '."""
    names = "|".join(re.escape(label) for label in sorted(labels, key=len, reverse=True))
    # Cut behind the first label, then before the next one.
    behind = nz(F.get(F.split(nz(text), rf"(?i)(?:{names})\s*:?\s+", 2), F.lit(1)))
    value = F.get(F.split(behind, rf"(?i)\s+(?:{names})\s*:|\s{{2,}}|\n", 2), F.lit(0))
    return squeeze(F.substring_index(value, ". ", 1))


def skill_hits(text: Column, terms: Sequence[str]) -> Column:
    return F.array_join(matched_terms(F.lower(text), terms), ", ")


def cut_at_word(value: Column, length: int, ending: str = "") -> Column:
    """At most ``length`` characters, cut before the last space."""
    text = squeeze(value)
    head = F.substring(text, 1, length)
    cut = F.concat(F.regexp_replace(head, r" [^ ]*$", ""), F.lit(ending))
    return F.when(F.length(text) <= length, text).otherwise(cut)


def slug(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(nz(value))), "[^a-z0-9]+", "-"), F.lit("-"))


def title_from_url(url: Column, cut_underscore: bool = True, drop_number: bool = False,
                   drop_suffix: str = "", otherwise: str = "", drop_query: bool = False) -> Column:
    """Readable title from the last path segment of a URL."""
    whole = F.regexp_replace(nz(url), r"(?s)[?#].*$", "") if drop_query else nz(url)
    last = F.element_at(F.split(F.rtrim(whole, F.lit("/")), "/"), -1)
    if drop_suffix:
        last = F.regexp_replace(last, rf"-\d+{re.escape(drop_suffix)}$", "")
        last = F.replace(last, F.lit(drop_suffix), F.lit(""))
    if cut_underscore:
        last = F.substring_index(last, "_", 1)
    if drop_number:
        last = F.regexp_replace(last, r"\d+$", "")
    title = squeeze(unescape(F.replace(last, F.lit("-"), F.lit(" "))))
    return first_filled(title, F.lit(otherwise)) if otherwise else title


def split_title(value: Column) -> tuple[Column, Column]:
    """('Title', 'Company') from 'Title at Company', else 'Title - Company'."""
    text = nz(value)
    at, dash = F.instr(text, " at "), F.instr(text, " - ")

    def rest(position: Column, width: int) -> Column:
        return F.trim(F.substr(text, position + width))

    def head(position: Column) -> Column:
        return F.trim(F.substr(text, F.lit(1), position - 1))

    title = F.when(at > 0, head(at)).when(dash > 0, head(dash)).otherwise(F.trim(text))
    company = F.when(at > 0, rest(at, 4)).when(dash > 0, rest(dash, 3)).otherwise(F.lit(""))
    return title, company


def distinct_items(items: Column) -> Column:
    """Case-insensitive first occurrences of a text array, blanks dropped."""
    cleaned = F.filter(F.transform(items, lambda x: strip_space(x)), lambda x: x != "")
    rows = let(cleaned, lambda c: F.struct(c.alias("items"), F.transform(c, lambda x: F.lower(x)).alias("keys")))
    return let(rows, lambda r: F.transform(
        F.array_distinct(r["keys"]), lambda key: F.get(r["items"], (F.array_position(r["keys"], key) - 1).cast("int"))))


def to_int(value: Column) -> Column:
    """Tolerant integer: null, empty and bad text become 0."""
    return F.coalesce(value.try_cast("int"), F.lit(0))


def to_flag(value: Column) -> Column:
    return F.lower(F.trim(nz(value))) == "true"

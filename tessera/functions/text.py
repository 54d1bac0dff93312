"""String normalisation and literal matching as columns.

Null and empty operands: normalisers give null for null unless they say otherwise; predicates give false, never null.
Case is folded with lower(); compatibility characters are not decomposed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[ \t\n\r\f\x0b]+"
#: A printed number: sign, thousands separators, decimals, exponent; not inside a word or a longer number.
NUMBER = r"(?<![\w.])[-+]?(?:\d{1,3}(?:,\d{3})+|\d+|\.\d+)(?:\.\d+)?(?:[eE][-+]?\d+)?(?![\w.])"


def literal(x: Column) -> Column:
    """A pattern that matches x itself."""
    return F.concat(F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E"))


def _true(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _text(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def evidence_text(x: Column) -> Column:
    """No-break space to space, minus sign to hyphen, white space single, trimmed; null stays null."""
    return F.trim(F.regexp_replace(F.translate(x, " −", " -"), BLANKS, " "))


def semantic_name(x: Column) -> Column:
    """Letters and digits in lower case, one space between; null gives the empty text."""
    return F.trim(F.regexp_replace(F.lower(_text(x)), "[^a-z0-9]+", " "))


def measured_name(x: Column) -> Column:
    """As semantic_name, percent signs kept and the minus sign folded."""
    return F.trim(F.regexp_replace(F.lower(F.translate(_text(x), "−", "-")), "[^a-z0-9%]+", " "))


def reference_name(x: Column) -> Column:
    """As semantic_name, with . % + - kept."""
    return F.trim(F.regexp_replace(F.lower(_text(x)), "[^a-z0-9.%+-]+", " "))


def printed_name(x: Column) -> Column:
    """Lower case, punctuation to spaces, one space between; words of any script stay; null gives the empty text."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_text(x)), r"(?U)[^\w\s]+", " "), r"(?U)\s+", " "))


def slug(x: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "-"), F.lit("-"))


def dataset_key(x: Column) -> Column:
    """A name without a trailing parenthesis, the words for a data set, and punctuation; null when nothing is left."""
    bare = F.regexp_replace(F.trim(x), r"\s*\([^)]*\)\s*$", "")
    plain = F.regexp_replace(F.lower(bare), r"\b(?:benchmark|dataset|corpus|data ?set)\b", " ")
    return F.nullif(F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " ")), F.lit(""))


def language_code(x: Column, codes: dict[str, str]) -> Column:
    """The code of a written language by codes (names in lower-case letters); null where it is not listed."""
    known = F.create_map(*[F.lit(v) for pair in codes.items() for v in pair])
    return F.try_element_at(known, F.regexp_replace(F.lower(x), "[^a-z]+", ""))


def tokens(x: Column) -> Column:
    """Parts between semicolons, trimmed, without empty ones; of null none."""
    return F.filter(F.transform(F.split(_text(x), ";"), lambda t: F.trim(t)), lambda t: t != "")


def words(x: Column) -> Column:
    return F.filter(F.split(x, " "), lambda w: w != "")


def names_compatible(a: Column, b: Column) -> Column:
    """Equal, empty, or one's words within the other's; null is empty."""
    x, y = semantic_name(a), semantic_name(b)
    return (x == "") | (y == "") | _within(x, y)


def labels_compatible(a: Column, b: Column) -> Column:
    """As names_compatible, but an empty label fits none."""
    x, y = measured_name(a), measured_name(b)
    return (x != "") & (y != "") & _within(x, y)


def _within(x: Column, y: Column) -> Column:
    return (F.size(F.array_except(words(x), words(y))) == 0) | (F.size(F.array_except(words(y), words(x))) == 0)


def similar(a: Column, b: Column) -> Column:
    """Neither empty, and equal or one contained in the other."""
    x, y = reference_name(a), reference_name(b)
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))


def agrees(a: Column, b: Column) -> Column:
    """As similar over plain names, but an empty name agrees with all."""
    x, y = semantic_name(a), semantic_name(b)
    return (x == "") | (y == "") | F.contains(x, y) | F.contains(y, x)


def coverage_label_matches(anchor: Column, covered: Column) -> Column:
    """Equal, or one begins with the other's whole words."""
    x, y = reference_name(anchor), reference_name(covered)
    begins = lambda p, q: F.startswith(p, F.concat(q, F.lit(" ")))
    return (x != "") & (y != "") & ((x == y) | begins(x, y) | begins(y, x))


def contains_term(text: Column, term: Column) -> Column:
    """Whole words of term within text, both normalised already."""
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    return _true(F.contains(pad(text), pad(term)))


def phrase_present(text: Column, phrase: Column) -> Column:
    """Whole words of phrase within text; an empty phrase is nowhere."""
    return (measured_name(phrase) != "") & contains_term(measured_name(text), measured_name(phrase))


def _folded(x: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.translate(_text(x), " −", " -"), BLANKS, " ")))


def literal_present(text: Column, claim: Column) -> Column:
    """The literal, not touching word characters, commas or points; white space, case and minus signs folded; an empty one is nowhere."""
    quoted = F.concat(F.lit(r"(?<![\w.,])"), literal(_folded(claim)), F.lit(r"(?![\w.,])"))
    return (_folded(claim) != "") & F.regexp_like(_folded(text), quoted)


def number_present(text: Column, value: Column) -> Column:
    """Whether text prints a number equal to value, thousands separators and exponents read; no number is nowhere."""
    number = lambda c: c.cast("string").try_cast("decimal(38,15)")
    found = F.regexp_extract_all(F.translate(_text(text), "−", "-"), F.lit(NUMBER), F.lit(0))
    return _true(F.exists(found, lambda n: _true(number(F.replace(n, F.lit(","), F.lit(""))) == number(value))))


def claim_present(text: Column, claim: Column) -> Column:
    """A text claim: as a literal if it holds a digit, else as a phrase."""
    return F.when(F.regexp_like(_text(claim), F.lit(r"\d")), literal_present(text, claim)).otherwise(phrase_present(text, claim))


def bounded_claim_present(text: Column, claim: Column) -> Column:
    """The literal as printed; one with digits may not be a part of a longer number, sign and scientific notation included.

    An empty claim is present everywhere.
    """
    left = r"(?<![\d+\-−^])(?<!\d[.,])(?<!\d[eE]\s{0,20})"
    power = r"(?![eE]\s*[+\-−]?\s*\d)(?!\s*[xX×]\s*10\s*(?:\^\s*)?[+\-−]?\s*\d)"
    bounded = F.concat(F.lit(left), literal(_text(claim)), F.lit(r"(?![\d^])(?![.,+\-−]\d)" + power))
    digits = F.regexp_like(_text(claim), F.lit(r"\d"))
    return (_text(claim) == "") | F.when(digits, F.regexp_like(_text(text), bounded)).otherwise(F.contains(_text(text), _text(claim)))


def quote_occurrences(quote: Column, lines: Column) -> Column:
    """How often a quote occurs in a page's lines: within a line as it is; one of several lines as whole consecutive lines, white space folded.

    A quote with an empty line, and an empty quote, occur nowhere.
    """
    own = F.transform(F.split(quote, "\n"), evidence_text)
    page = F.transform(lines, evidence_text)
    within = F.aggregate(lines, F.lit(0), lambda n, x: n + ((F.length(x) - F.length(F.replace(x, quote, F.lit("")))) / F.length(quote)).cast("int"))
    n = F.size(page) - F.size(own) + 1
    starts = F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    whole = F.size(F.filter(starts, lambda i: F.slice(page, i, F.size(own)) == own))
    several = F.when(F.exists(own, lambda x: x == ""), 0).otherwise(whole)
    return F.when(_text(quote) == "", 0).when(F.contains(quote, F.lit("\n")), several).otherwise(within)


def quote_clauses(x: Column) -> Column:
    """Parts of a quote that can hold one statement: split at line ends, semicolons and spaced bars; none empty."""
    return F.filter(F.transform(F.split(_text(x), r"[\r\n]+|[;；]+|\s+\|\s+"), lambda t: F.trim(t)), lambda t: t != "")


def quote_on_page(quote: Column, page: Column) -> Column:
    """Containment with white space made single; an empty quote is nowhere."""
    q = evidence_text(quote)
    return _true((q != "") & F.contains(evidence_text(page), q))


def bare_value(raw: Column) -> Column:
    """A printed value without comparators before it and footnote or percent signs after it."""
    return F.regexp_replace(F.regexp_replace(F.trim(_text(raw)), r"^[<>=~≈≤≥\s]+", ""), r"[%*†‡§\s]+$", "")


def numeric_token_present(quote: Column, raw: Column) -> Column:
    """The bare value as a whole number, not inside a longer one; an empty one is nowhere."""
    pattern = F.concat(F.lit(r"(?<![\d.,])"), literal(bare_value(raw)), F.lit(r"(?![\d,]|\.\d)"))
    return (bare_value(raw) != "") & F.regexp_like(evidence_text(_text(quote)), pattern)


def name_in(quote: Column, name: Column) -> Column:
    """The name within the quote, white space and case folded; an empty name is nowhere."""
    return (_text(name) != "") & F.contains(F.lower(evidence_text(_text(quote))), F.lower(evidence_text(_text(name))))


def numbers(x: Column) -> Column:
    """Printed numbers as decimals, thousands separators and exponents read; numbers beyond 23 digits are null."""
    found = F.regexp_extract_all(F.translate(_text(x), "−", "-"), F.lit(NUMBER), F.lit(0))
    return F.transform(found, lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("decimal(38,15)"))


def numeric_mentions(x: Column) -> Column:
    """(number, unit) of printed numbers with k, m or b for thousands and so on, unit percent where the sign follows."""
    pattern = r"(?<![A-Za-z0-9_.])([+-]?(?:\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?|\.\d+))\s*([kKmMbB])?\s*(%)?(?![A-Za-z0-9_.])"
    part = lambda i: F.regexp_extract_all(_text(x), F.lit(pattern), F.lit(i))
    scale = lambda m: F.when(F.lower(m) == "k", 1e3).when(F.lower(m) == "m", 1e6).when(F.lower(m) == "b", 1e9).otherwise(1.0)
    return F.transform(
        F.arrays_zip(part(1).alias("n"), part(2).alias("m"), part(3).alias("p")),
        lambda t: F.struct(
            (F.replace(t["n"], F.lit(","), F.lit("")).cast("double") * scale(t["m"])).alias("number"), F.when(t["p"] == "%", "percent").alias("unit")
        ),
    )


def dated_venue(x: Column) -> Column:
    """A year or a word for a shared task."""
    return F.regexp_like(_text(x), F.lit(r"(?i)(?<!\d)(?:19|20)\d{2}(?!\d)|\b(?:shared[- ]task|task\s*\d|challenge|competition)\b"))


def venue_like(x: Column) -> Column:
    """A dated venue, or a first word (but for an article) with a digit, or a capital after its first letter."""
    first = F.try_element_at(F.filter(words(_text(x)), lambda w: ~F.lower(w).isin("the", "a", "an")), F.lit(1))
    return dated_venue(x) | _true(F.regexp_like(first, F.lit(r"\d|^.+[A-Z]")))


def handle_like(x: Column) -> Column:
    """Some word holds a capital, digit, _ or - after its first character."""
    return F.exists(words(_text(x)), lambda w: F.regexp_like(w, F.lit(r"^.+[A-Z0-9_-]|^.[A-Z0-9_-]")))


def hash_key(seed: str, *parts: Column, sep: str = "|") -> Column:
    """The seeded order key: SHA-256 of the seed and the parts."""
    return F.sha2(F.concat_ws(sep, F.lit(seed), *[p.cast("string") for p in parts]), 256)


def json_hash(*parts: Column) -> Column:
    """SHA-256 of the parts as a compact JSON array of texts."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def entry_id(name: Column, kind: Column) -> Column:
    """The id of an inventory entry: a hash of its printed name and kind."""
    return F.concat(F.lit("ds_"), F.substring(json_hash(name, kind), 1, 20))


def stable_key(x: Column) -> Column:
    """A readable key: the slug's first 48 characters and 8 digits of the hash; the digits alone where the slug is empty."""
    own, digest = F.btrim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), F.lit("-")), F.substring(F.sha2(x, 256), 1, 8)
    return F.when(own == "", digest).otherwise(F.concat_ws("-", F.substring(own, 1, 48), digest))


def system_key(system: Column, version: Column) -> Column:
    """The key of a system and, where it is known, its version."""
    return F.when(version.isNull(), stable_key(system)).otherwise(F.concat(stable_key(system), F.lit("-version-"), stable_key(version)))

"""Text functions: normal form, fingerprints, speaker roles, names, small grammars.

Each takes and returns columns. Only Unicode normalisation leaves the JVM (Spark has no such function), as an Arrow
UDF; all else is built in.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.isspace() has it; Java's class lacks the separators U+001C to U+001F.
BLANK = r"(?U)[\s\x1c-\x1f]"
BLANKS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
FINGERPRINT_LENGTH = 10
#: All boundaries of str.splitlines(); a carriage return and line feed are one.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: Fixed value: the grammar of an utterance, 'Speaker: text'.
UTTERANCE = r"(?U)^([A-Za-zÀ-ÿ][\w '\-À-ÿ]*)[\s\x1c-\x1f]*:[\s\x1c-\x1f]*([^\n]+)$"
MARKUP = r"\[[^\]]*\]|\{[^}]*\}"
NOT_IN_NAMES = r"(?U)[^\p{L}\p{N}\s\x1c-\x1f'_-]"
FIRST_NAME = r"(?U)^[\s\x1c-\x1f'_-]*([\p{L}\p{N}]*)"
#: Roles that speak with another role's voice.
VOICE_FOLDERS = {"narrator": "arthur", "narrateur": "arthur", "note": "arthur"}
#: Speech rate in characters a second, and the shortest expected duration.
CHARS_PER_SECOND = 14.0
SHORTEST_SECONDS = 0.6


def _unless_ascii(change):
    """change, as an Arrow UDF that only sees texts beyond ASCII: all others stay in the JVM as they are."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(change, na_action="ignore")

    def column(text: Column) -> Column:
        return F.coalesce(run(F.when(text.rlike(r"[^\x00-\x7f]"), text)), text)

    return column


def _form(name: str):
    return _unless_ascii(lambda x: unicodedata.normalize(name, x))


nfc, nfd, nfkd = _form("NFC"), _form("NFD"), _form("NFKD")


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.btrim(F.regexp_replace(text, BLANK + "+", " "), F.lit(" "))


def stripped(text: Column) -> Column:
    """Without white space at the ends."""
    return F.btrim(text, F.lit(BLANKS))


def normalise_text(text: Column) -> Column:
    """NFC, white space squeezed. Case, accents and punctuation stay: they change what is said."""
    return squeeze(nfc(text))


def fingerprint(text: Column, normalised: bool = False) -> Column:
    """The first ten hex digits of the normal form's SHA-256; empty for an empty text."""
    n = text if normalised else normalise_text(text)
    return F.when(n == "", F.lit("")).otherwise(F.substring(F.sha2(n, 256), 1, FINGERPRINT_LENGTH))


def without_accents(x: str) -> str:
    """Without accents, and in lower case character by character: no rule that looks at a whole word, such as that of the final sigma."""
    return "".join(c.lower() for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c))


_unaccented = _unless_ascii(without_accents)


def role_of_speaker(name: Column) -> Column:
    """'José Álvarez' -> 'jose': no accents, first word, letters and digits only, lower case."""
    plain = F.regexp_replace(_unaccented(name.cast("string")), NOT_IN_NAMES, "")
    word = F.regexp_extract(plain, FIRST_NAME, 1)
    return F.lower(word)


def voice_folder(role: Column) -> Column:
    out = role
    for r, folder in VOICE_FOLDERS.items():
        out = F.when(role == r, F.lit(folder)).otherwise(out)
    return out


def clip_id(role: Column, mark: Column) -> Column:
    """role_fingerprint, or null if either is empty."""
    return F.when((role != "") & (mark != ""), F.concat(role, F.lit("_"), mark))


def clip_path(role: Column, mark: Column) -> Column:
    return F.concat(voice_folder(role), F.lit("/"), clip_id(role, mark), F.lit(".ogg"))


def slug(text: Column, default: str = "voix", words: int = 4) -> Column:
    """Up to four [a-z0-9]+ words of the compatibility form, joined by dashes."""
    ascii_only = F.regexp_replace(nfkd(text), r"[^\x00-\x7f]", "")
    found = F.slice(F.regexp_extract_all(F.lower(ascii_only), F.lit("[a-z0-9]+"), F.lit(0)), 1, words)
    return F.coalesce(F.nullif(F.array_join(found, "-"), F.lit("")), F.lit(default))


def strip_markup(text: Column) -> Column:
    """[..] and {..} become a blank; white space squeezed."""
    return squeeze(F.regexp_replace(text, MARKUP, " "))


def chapter_label(stem: Column) -> Column:
    """'chapter_07a' -> 'ch07'; a name without digits stays."""
    digits = F.regexp_extract(stem, r"(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("ch"), digits)).otherwise(stem)


def chapter_number(label: Column) -> Column:
    """The number of 'ch12' or 'ch12b'; null for anything else."""
    return F.nullif(F.regexp_extract(label, r"^ch(\d+)[a-z]*$", 1), F.lit("")).cast("int")


def first_number(label: Column) -> Column:
    """The first run of digits anywhere; null without one."""
    return F.nullif(F.regexp_extract(label, r"(\d+)", 1), F.lit("")).cast("int")


def chapter_file(number: Column) -> Column:
    return F.format_string("chapter_%02d", number)


def path_safe(spec: Column) -> Column:
    return F.translate(spec, ":.+", "--_")


def markdown_cell(text: Column) -> Column:
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def short_decimal(x: Column) -> Column:
    """'0.75' -> '075', for file names."""
    return F.replace(F.format_string("%.2f", x), F.lit("."), F.lit(""))


def parse_clip_name(name: Column) -> Column:
    """struct(convention, role, chapter, rank, mark): positional role_chNN_II, by fingerprint, or unknown."""
    old, new = r"^([a-z0-9]+)_ch(\d+)_(\d+)$", r"^([a-z0-9]+)_([0-9a-f]{10})$"
    some = lambda p, i: F.nullif(F.regexp_extract(name, p, i), F.lit(""))
    kind = F.when(name.rlike(new), "fingerprint").when(name.rlike(old), "positional").otherwise("unknown")
    return F.struct(
        kind.alias("convention"),
        F.when(kind == "fingerprint", some(new, 1)).when(kind == "positional", some(old, 1)).alias("role"),
        F.when(kind == "positional", some(old, 2).cast("int")).alias("chapter"),
        F.when(kind == "positional", some(old, 3).cast("int")).alias("rank"),
        F.when(kind == "fingerprint", some(new, 2)).alias("mark"),
    )


def pronounceable(text: Column) -> Column:
    return text.rlike("[0-9A-Za-zÀ-ÿ]")


def byte_sum_seed(name: Column, base: int = 0) -> Column:
    """base + the sum of the UTF-8 bytes modulo 10,000: a seed that is the same in every process."""
    n = F.octet_length(name)
    raw = F.hex(name.cast("binary"))
    byte = lambda i: F.conv(F.substr(raw, 2 * i - 1, F.lit(2)), 16, 10).cast("int")
    total = F.when(n > 0, F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), byte), F.lit(0), lambda a, x: a + x)).otherwise(0)
    return base + total % 10_000


def expected_seconds(text: Column) -> Column:
    return F.greatest(F.lit(SHORTEST_SECONDS), F.length(text) / F.lit(CHARS_PER_SECOND))


def json_list(text: Column, n: int) -> Column:
    """The first JSON array inside free text: its first n strings that aren't blank."""
    found = F.from_json(F.regexp_extract(text, r"(?s)(\[.*\])", 1), "array<string>")
    return F.slice(F.filter(F.transform(found, squeeze), lambda x: x != ""), 1, n)


def last_line(text: Column) -> Column:
    """The last line, without white space and quotes around it."""
    line = F.element_at(F.split(F.btrim(text, F.lit(" \t\r\n")), "\n"), -1)
    return F.btrim(line, F.lit(" \t\r\"'«»"))


def option_pairs(options: Column) -> Column:
    """['k=v', ...] -> map; malformed ones are left out, the last of equal keys wins."""
    parts = F.filter(F.transform(options, lambda o: F.split(o, "=", 2)), lambda p: F.size(p) == 2)
    last = lambda acc, p: F.map_concat(F.map_filter(acc, lambda k, _: k != F.trim(p[0])), F.create_map(F.trim(p[0]), F.trim(p[1])))
    return F.aggregate(parts, F.expr("cast(map() as map<string,string>)"), last)


# mixes: 'name[:weight](+name[:weight])*'


def parse_mix(spec: Column, allowed: list[str] | None = None) -> Column:
    """map name -> weight. A bare name weighs 1, names are lower-cased, the last of equal names wins, empty parts are
    skipped. With `allowed`, an unknown name or an empty mix is an error; without, anything goes."""
    parts = F.filter(F.transform(F.split(spec, r"\+"), lambda p: F.trim(p)), lambda p: p != "")

    def add(acc: Column, part: Column) -> Column:
        bits = F.split(part, ":", 2)
        name = F.lower(F.trim(bits[0]))
        weight = F.coalesce(F.nullif(F.trim(F.try_element_at(bits, F.lit(2))), F.lit("")), F.lit("1")).cast("double")
        return F.map_concat(F.map_filter(acc, lambda k, _: k != name), F.create_map(name, weight))

    mix = F.aggregate(parts, F.expr("cast(map() as map<string,double>)"), add)
    if allowed is None:
        return mix
    unknown = F.array_except(F.map_keys(mix), F.array(*map(F.lit, allowed)))
    bad = (F.size(unknown) > 0) | (F.size(mix) == 0)
    return F.when(bad, F.raise_error(F.concat(F.lit("unknown or empty mix: "), spec)).cast("map<string,double>")).otherwise(mix)


def dose_mix(base: Column, dose: Column, component: Column) -> Column:
    """The base mix at weight 1 - dose and the component at dose, three decimals; dose 0 is the base itself."""
    part = lambda name, w: F.concat(name, F.lit(":"), F.format_string("%.3f", w))
    scaled = F.transform(F.split(base, r"\+"), lambda p: part(F.split(p, ":")[0], F.coalesce(F.try_element_at(F.split(p, ":"), F.lit(2)).cast("double"), F.lit(1.0)) * (1 - dose)))
    return F.when(dose <= 0, base).otherwise(F.concat(F.array_join(scaled, "+"), F.lit("+"), part(component, dose)))


def mix_share(mix: Column, names: list[str]) -> Column:
    """Share of the named components in a mix, two decimals (half to even)."""
    add = lambda m: F.aggregate(F.map_values(m), F.lit(0.0), lambda a, x: a + x)
    return F.bround(add(F.map_filter(mix, lambda k, _: k.isin(names))) / F.greatest(add(mix), F.lit(1e-12)), 2)


def mix_kinds(mix: Column, kind_of: dict[str, str]) -> Column:
    """'F', 'M' or 'F+M': the kinds of the mix's components."""
    table = F.create_map(*[F.lit(x) for kv in kind_of.items() for x in kv])
    kinds = F.array_distinct(F.transform(F.map_keys(mix), lambda k: F.try_element_at(table, k)))
    return F.array_join(F.array_sort(F.filter(kinds, lambda k: k.isNotNull())), "+")


def dominant(mix: Column) -> Column:
    """The component of the greatest weight; the first of equals."""
    entries = F.map_entries(mix)
    best = F.aggregate(entries, entries[0], lambda a, e: F.when(e["value"] > a["value"], e).otherwise(a))
    return F.when(F.size(mix) > 0, best["key"])

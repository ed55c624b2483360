"""Problem 1: visually identical text with different characters.

Method: DuckDB runs inside Arrow partitions; ``nfc_normalize``, ``translate`` and regular expressions are
expressed as SQL that is embedded in the task. Nothing is shuffled; each Arrow batch is one DuckDB relation.

Two forms come out of it:

* ``canonical``: the text as a reader would type it. Full-width forms are ordinary, combining marks are
  composed, invisible characters are gone, every blank is U+0020, and each word is in one script: a word with
  letters that only Cyrillic has gets its look-alikes from Cyrillic, a word with letters that only Latin has
  gets them from Latin, and a word made of look-alikes only follows the script that prevails in the text.
* ``form_key``: 16 bytes that are equal exactly if two texts look the same; the digest of the canonical text
  with every look-alike mapped to Latin. Letter case, accents and raised digits stay different.

Null text gives null in both. Blank text gives an empty canonical text. Texts of any length are handled whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pairs of letters that look alike, Cyrillic (or Greek) first, Latin second.
CYRILLIC_LATIN = [
    ("а", "a"), ("с", "c"), ("е", "e"), ("о", "o"), ("р", "p"), ("х", "x"), ("у", "y"), ("і", "i"),
    ("ј", "j"), ("ѕ", "s"), ("һ", "h"), ("ԁ", "d"), ("ԛ", "q"), ("ԝ", "w"),
    ("А", "A"), ("В", "B"), ("С", "C"), ("Е", "E"), ("Н", "H"), ("К", "K"), ("М", "M"), ("О", "O"),
    ("Р", "P"), ("Т", "T"), ("Х", "X"), ("У", "Y"), ("І", "I"), ("Ј", "J"), ("Ѕ", "S"),
    ("ё", "ë"), ("Ё", "Ë"), ("ї", "ï"), ("Ї", "Ï"),
]
GREEK_LATIN = [
    ("Α", "A"), ("Β", "B"), ("Ε", "E"), ("Ζ", "Z"), ("Η", "H"), ("Ι", "I"), ("Κ", "K"), ("Μ", "M"),
    ("Ν", "N"), ("Ο", "O"), ("Ρ", "P"), ("Τ", "T"), ("Υ", "Y"), ("Χ", "X"), ("ο", "o"), ("ν", "v"),
]
# Forms that Unicode calls compatible and that also look the same.
COMPATIBLE = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"), ("…", "..."), ("ĳ", "ij"), ("Ĳ", "IJ"), ("ǆ", "dž"), ("ǉ", "lj"), ("ǌ", "nj")]

# Letters of other alphabets and phonetic signs that look like a letter of the two alphabets.
EXOTIC = [
    ("ɡ", "g"), ("ց", "g"), ("օ", "o"), ("ո", "n"), ("ս", "u"), ("հ", "h"), ("զ", "q"), ("ϳ", "j"), ("ѵ", "v"), ("ӏ", "l"), ("Ӏ", "I"),
    ("ᴏ", "o"), ("ᴠ", "v"), ("ᴡ", "w"), ("ᴢ", "z"), ("ᴄ", "c"), ("ꜱ", "s"), ("ĸ", "к"), ("Ꭺ", "A"), ("Ꮯ", "C"), ("Ꮋ", "H"), ("Ꮶ", "K"), ("Ꮇ", "M"), ("Ꭲ", "T"),
]
#: By rule, from the Unicode tables: fonts of a letter or digit (mathematical, script, double-struck), and Roman numerals.
FONTS = [(chr(c), d) for c in (*range(0x2100, 0x2150), *range(0x1D400, 0x1D800), *range(0xFB20, 0xFB50)) if unicodedata.decomposition(chr(c)).startswith("<font>") and len(d := unicodedata.normalize("NFKC", chr(c))) == 1]
NUMERALS = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in range(0x2160, 0x2180) if unicodedata.decomposition(chr(c)).startswith("<compat>")]

_BLANKS = "\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000\t\r\x0b\x0c\x85\u2028\u2029"
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F)))
_HYPHENS = "\u2010\u2011"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _translate(expr: str, pairs: Iterable[tuple[str, str]]) -> str:
    a, b = zip(*pairs)
    return f"translate({expr}, {_quote(''.join(a))}, {_quote(''.join(b))})"


_INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}\x{200C}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}]+"
#: Characters beyond plain text that any of the first steps would change.
_SPECIAL = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{0300}-\x{036F}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2010}\x{2011}\x{2026}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FF01}-\x{FF5E}\x{FB00}-\x{FB06}\x{0085}\t\r\x0b\x0c\x{0132}\x{0133}\x{01C6}\x{01C9}\x{01CC}\x{2100}-\x{214F}\x{2160}-\x{217F}\x{1D400}-\x{1D7FF}\x{FB20}-\x{FB4F}" + "".join(a for a, _ in EXOTIC) + "]"
_CYR_ALIKE = "".join(a for a, _ in CYRILLIC_LATIN)
_LAT_ALIKE = "".join(b for _, b in CYRILLIC_LATIN)
#: Look-alikes that Cyrillic texts of today hardly have: a word with them and nothing Cyrillic is Latin.
_RARE = "jshdqwJSјѕһԁԛԝЈЅ"
#: Letters that tell a word's script.
_CYR_ONLY = "[" + "".join(chr(c) for c in range(0x400, 0x530) if chr(c) not in _CYR_ALIKE and chr(c).isalpha()) + "]"
_LAT_ONLY = "[" + _RARE + "".join(chr(c) for c in range(0x41, 0x17F) if chr(c) not in _LAT_ALIKE and chr(c).isalpha() and c not in (0xAA, 0xB5, 0xBA)) + "]"


def _visible(t: str) -> str:
    """SQL: without invisible characters; a joiner stays between two pictographs only."""
    joined = f"regexp_replace(regexp_replace({t}, '[\\x{{FE00}}-\\x{{FE0F}}]+', '', 'g'), '([\\p{{So}}\\p{{Sk}}])\\x{{200D}}([\\p{{So}}])', '\\1\\x{{E000}}\\2', 'g')".replace("\\x{E000}", "\ue000")
    again = f"regexp_replace({joined}, '([\\p{{So}}\\p{{Sk}}])\\x{{200D}}([\\p{{So}}])', '\\1\ue000\\2', 'g')"
    kept = f"replace(replace({again}, chr(8205), ''), '\ue000', chr(8205))"
    return f"regexp_replace(CASE WHEN contains({t}, chr(8205)) THEN {kept} ELSE {t} END, '{_INVISIBLE}', '', 'g')"


def _plain(t: str) -> str:
    """SQL: invisible characters out, forms and blanks ordinary, marks composed."""
    alike = list(zip(_WIDE, _NARROW)) + [(b, " ") for b in _BLANKS] + [(h, "-") for h in _HYPHENS]
    out = _translate(_visible(t), alike + FONTS + EXOTIC)
    for a, b in sorted(COMPATIBLE + NUMERALS, key=lambda x: x[0]):
        out = f"replace({out}, {_quote(a)}, {_quote(b)})"
    return f"CASE WHEN regexp_matches({t}, '{_SPECIAL}') THEN nfc_normalize({out}) ELSE {t} END"


def canonical_sql(source: str, text: str = "text", keep: str = "*") -> str:
    """DuckDB SQL over relation ``source`` that adds ``canonical`` to the columns ``keep``."""
    back = {b: a for a, b in CYRILLIC_LATIN}
    to_cyr = _translate("x", [*((b, a) for a, b in CYRILLIC_LATIN), *((g, back[b]) for g, b in GREEK_LATIN if b in back)])
    to_lat = _translate("x", CYRILLIC_LATIN + GREEK_LATIN)
    word = "[\\p{L}\\p{M}\\p{N}]+|[^\\p{L}\\p{M}\\p{N}]+"
    return f"""
        WITH plain AS (SELECT {keep}, {_plain(text)} AS _p FROM {source}),
        scripts AS (
            SELECT *, regexp_matches(_p, '\\p{{Greek}}') OR regexp_matches(_p, '\\p{{Latin}}') AND (regexp_matches(_p, '\\p{{Cyrillic}}') OR NOT regexp_matches(_p, '{_LAT_ONLY}')) OR regexp_matches(_p, '[јѕһԁԛԝЈЅ]') AS _both,
                   CASE WHEN _both THEN len(regexp_extract_all(_p, '{_CYR_ONLY}')) >= len(regexp_extract_all(_p, '{_LAT_ONLY}')) END AS _cyr
            FROM plain)
        SELECT * EXCLUDE (_p, _both, _cyr), trim(CASE WHEN _both THEN nfc_normalize(array_to_string(list_transform(
            regexp_extract_all(_p, '{word}'),
            lambda x: CASE WHEN NOT regexp_matches(x, '[\\p{{L}}]') THEN x
                           WHEN regexp_matches(x, '{_CYR_ONLY}') THEN CASE WHEN regexp_matches(x, '[\\p{{Latin}}\\p{{Greek}}]') AND NOT regexp_matches(x, '{_LAT_ONLY}') THEN {to_cyr} ELSE x END
                           WHEN regexp_matches(x, '{_LAT_ONLY}') THEN CASE WHEN regexp_matches(x, '[\\p{{Cyrillic}}\\p{{Greek}}]') THEN {to_lat} ELSE x END
                           WHEN _cyr THEN {to_cyr} ELSE {to_lat} END), '')) ELSE _p END, chr(32) || chr(10)) AS canonical
        FROM scripts"""


def key_sql(canonical: str = "canonical") -> str:
    """DuckDB SQL: the text with every look-alike in Latin, for comparison only."""
    return f"nfc_normalize({_translate(canonical, CYRILLIC_LATIN + GREEK_LATIN)})"


def words_sql(canonical: str = "canonical") -> str:
    """DuckDB SQL: the runs of letters and digits, in lower case, words of look-alikes only in one spelling."""
    lower = [(a, b) for a, b in CYRILLIC_LATIN if a == a.lower()]
    return f"regexp_extract_all({_translate(f'lower({canonical})', lower)}, '[\\p{{L}}\\p{{M}}\\p{{N}}]+')"


#: Bytes of a batch that DuckDB gets at once; word lists take several times as much.
PORTION = 16 << 20


def _portions(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, int(b.num_rows * PORTION / max(b.nbytes, 1)))
    for at in range(0, b.num_rows, step):
        yield b.slice(at, step)


def duckdb_batches(sql: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run ``sql`` over each Arrow batch (large ones in portions) as relation ``batch``, in one thread of the task's own DuckDB."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "700MB"})
    for whole in batches:
        for b in _portions(whole):
            con.register("batch", pa.Table.from_batches([b]))
            yield from con.sql(sql).to_arrow_table().to_batches()
            con.unregister("batch")


def with_canonical(df: DataFrame, text: str = "text", canonical: str = "canonical", form_key: str | None = "form_key") -> DataFrame:
    """``df`` with the canonical text and, unless ``form_key`` is None, its comparison key.

    Columns of ``df`` with the names of the new ones are replaced. Other columns pass through unchanged.
    """
    new = [canonical] + ([form_key] if form_key else [])
    rest = [c for c in df.columns if c not in new or c == text]
    numbered = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    at = rest.index(text)
    schema = T.StructType([T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(rest)] + [T.StructField("canonical", T.StringType())] + ([T.StructField("form_key", T.BinaryType())] if form_key else []))
    inner = canonical_sql("batch", f"c{at}", "*")
    key = f", unhex(md5({key_sql()})) AS form_key" if form_key else ""
    sql = f"SELECT *{key} FROM ({inner})"
    out = numbered.mapInArrow(lambda it: duckdb_batches(sql, it), schema)
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(rest) if c not in new] + [F.col("canonical").alias(canonical)]
    return out.select(*named, *([F.col("form_key").alias(form_key)] if form_key else []))

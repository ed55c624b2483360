"""Problem 5: personal information inside free text.

Detection runs on a normalised copy of the text that keeps, for every character, its place in the original; so found
items can be replaced in the original and everything else stays as it is. Every text reaches the detector, which skips a
pattern only where a sign that the pattern can't match without is missing from the normalised text.

Replacement: typed placeholders (``[PHONE_1]``; TESTDATA's form), and surrogates by the method named: keyed, of the same
type, gender, script and format. Every part of an item has its own surrogate across the collection (coreference: a surname
keeps its own whoever bears it, whatever its case and gender). Distinctness holds by construction, part by part: digits,
initials and listed given names go through keyed permutations; surnames, patronymics, streets and mailboxes get three
syllables from a keyed hash, and parts whose syllables clash are told apart by further syllables that count them. Nothing
else of a part changes, so the surrogate of a part can't depend on the item it stands in.

Names in lower case without a telling suffix count only if the surname is known from the collection: it stands next to a
given name or initials, written as a name, in two deliveries or more. Given names that the lists lack are learned alike:
they stand before a patronymic, written as a name, in two deliveries or more. That list is a table, joined, not broadcast.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .canonical import _BLANKS, _NARROW, _WIDE, CYRILLIC_LATIN, GREEK_LATIN
from .pii_lexicon import GIVEN, GIVEN_EN_F, GIVEN_EN_M, GIVEN_KZ_F, GIVEN_KZ_M, GIVEN_RU_F, GIVEN_RU_M, HEADS, ROLES, SYLLABLES

_UNSEEN = re.compile("[­͏؜᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿]")
_MARKED = re.compile(r"[иеИЕiaeouІі][̀-ͯ]")
_ORDINARY = str.maketrans({**dict(zip(_WIDE, _NARROW)), **{b: " " for b in _BLANKS if b != "\n"}, "‐": "-", "‑": "-", "–": "-", "—": "-"})
_C2L, _L2C = {a: b for a, b in CYRILLIC_LATIN + GREEK_LATIN}, {b: a for a, b in CYRILLIC_LATIN}
_TO_LAT, _TO_CYR = str.maketrans(_C2L), str.maketrans({**_L2C, **{g: _L2C[b] for g, b in GREEK_LATIN if b in _L2C}})
_CYR_ALIKE = set(_L2C.values())
_MIXED = re.compile(r"[^\W\d_]+")
#: Without one of these no character is replaced by ``_ORDINARY``, and no word by ``_script``.
_UNUSUAL = re.compile("[" + re.escape("".join(map(chr, _ORDINARY))) + "]")
_SCRIPTS = re.compile(r"[Ͱ-Ͽ]|[Ѐ-ԯ][^\W\d_Ѐ-ԯ]|[^\W\d_Ѐ-ԯ][Ѐ-ԯ]")


def _script(m: re.Match) -> str:
    w = m[0]
    if w.isascii():
        return w
    cyr = any("Ѐ" <= c < "԰" and c not in _CYR_ALIKE for c in w)
    lat = any(c.isascii() and c not in _L2C for c in w)
    return w.translate(_TO_CYR) if cyr and not lat else w.translate(_TO_LAT) if lat and not cyr else w


def align(text: str) -> tuple[str, list[int] | None]:
    """Normalised text and the place of each of its characters in ``text`` (None: the same)."""
    at = None
    if _UNSEEN.search(text) or _MARKED.search(text):
        keep, out = [], []
        for i, c in enumerate(text):
            if _UNSEEN.match(c):
                continue
            if out and unicodedata.combining(c):
                c2 = unicodedata.normalize("NFC", out[-1] + c)
                if len(c2) == 1:
                    out[-1] = c2
                continue
            keep.append(i)
            out.append(c)
        text, at = "".join(out), keep
    if _UNUSUAL.search(text):
        text = text.translate(_ORDINARY)
    return (_MIXED.sub(_script, text) if _SCRIPTS.search(text) else text), at


_D = "[0-9OoОо]"
_EDGE, _END = r"(?<![^\W_])", r"(?![^\W_])"
_AT = r"(?:\s?@\s?|\s*[\(\[]\s*(?:at|собака|ат|ит)\s*[\)\]]\s*|\s+(?:собака|at)\s+(?=[\w-]+\s+(?:dot|точка|нүкте)\s))"
_DOT = r"(?:\.|\s*[\(\[]\s*(?:dot|точка|нүкте)\s*[\)\]]\s*|\s+(?:dot|точка|нүкте)\s+)"
EMAIL = re.compile(rf"(?<![\w.+-])[a-z0-9](?:[a-z0-9._+-]*[a-z0-9_])?{_AT}[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)+", re.IGNORECASE)
PERSONAL = re.compile(rf"(?<![\w-])({_D}{{6}})[ -]?({_D}{{6}})(?![\w-]*\d)")
PASSPORT = re.compile(r"(?<![\w])[^\W\d_] ?[0-9OoОо]{8}(?!\w)")
CARD = re.compile(r"(?:удостовер\w*|куәлі\w*|паспорт\w*|төлқұжат\w*|passport|\bid\b|identity card)(?:[^\d\n]{0,24}?)(№?\s?(?<![\d-])[0-9OoОо]{9}(?!\w))", re.IGNORECASE)
_S = r"[ .\-]{0,2}"
PHONE = re.compile(rf"(?<![\w+])(?:(?:(?:\+ ?7|8|7|[0OОoо]{{2}} ?7){_S}\(?{_S}[3-9]{_D}{{2}}|\(?7{_D}{{2}})\)?{_S}(?:{_D}{_S}){{6}}{_D})(?!\w)|(?<![\w])\+(?!7)\d{{1,3}}{_S}\(?(?:\d{_S}){{2,4}}\)?{_S}(?:\d{_S}){{6,8}}\d(?!\w)")

_N = r"\d{1,4}(?:[/\\]\d{1,4})?[а-гa-d]?"
_HOUSE = rf"(?:дом|д\.?|үй|house)?\s?{_N}(?:\s?-\s?\d{{1,4}})?"
_FLAT = r"(?:\s*,?\s*(?:(?:кв\.?|квартира|пәтер|flat|apt\.?|apartment|unit)\s?\d{1,4}|\d{1,4}[ -]?(?:пәтер|кв\.?|квартира)))?"
_W = r"[^\W\d_][\w-]*"
ADDRESS = [
    re.compile(rf"{_EDGE}(?:ул(?:\.|ица|ице|ицы|ицу)?(?![^\W_])|пр-т|пр-кт|просп(?:\.|ект|екте|екта)|пер(?:\.|еулок|еулке)|бульвар|бул\.|шоссе|мкр\.?|микрорайон)\s?{_W}(?:\s{_W})?,?\s+{_HOUSE}{_END}{_FLAT}", re.IGNORECASE),
    re.compile(rf"{_EDGE}{_W}\s(?:улица|ул\.|проспект|пр-т|переулок|пер\.|бульвар|шоссе|көшесі|к-сі|даңғылы|d-сі),?\s+(?:дом\s?|д\.?\s?|үй\s?)?{_N}(?:\s?-\s?\d{{1,4}})?(?:\s?үй)?{_END}{_FLAT}", re.IGNORECASE),
    re.compile(rf"{_EDGE}\d{{1,4}}(?:-?|\s)үй,?\s{_W}\s(?:көшесі|к-сі|даңғылы){_END}{_FLAT}", re.IGNORECASE),
    re.compile(rf"{_EDGE}{_N}\s{_W}(?:\s{_W})?\s(?:street|str?\.?|avenue|ave\.?|road|rd\.?|lane|ln\.?|drive|dr\.?|boulevard|blvd\.?|square|court){_END}{_FLAT}", re.IGNORECASE),
    re.compile(rf"{_EDGE}{_W}(?:\s{_W})?\s(?:street|avenue|ave\.?|road|rd\.?|lane|ln\.?|drive|boulevard|blvd\.?),?\s\d{{1,4}}(?:\s?[-/]\s?\d{{1,4}})?{_END}{_FLAT}", re.IGNORECASE),
    # A street as an adjective ("Снегиряной 135-168"): house and flat, or an entrance, must follow.
    re.compile(rf"{_EDGE}[^\W\d_]{{4,}}(?:ой|ая|ый|ом|ского|ской),?\s\d{{1,4}}\s?-\s?\d{{1,4}}{_END}", re.IGNORECASE),
]

_PATRONYMIC = re.compile(r"[а-яё]{3,}(?:ович|евич|овна|евна|ична|ич)|\w{2,}(?:ұлы|қызы|улы|кызы)|[a-z]{3,}(?:ovich|evich|ovna|evna|uly|kyzy)")
_SURNAME = re.compile(r"[а-яё-]{2,}(?:ов|ова|ев|ева|ёв|ёва|ин|ина|ын|ына|ский|ская|цкий|цкая|енко|ович|евич|чук|юк|ян)|[a-z-]{3,}(?:ov|ova|ev|eva|sky|skaya|enko)")
#: Patronymics beside names that no list has, with their case endings.
_STRONG = re.compile(r"[а-яё]{2,}(?:(?:ов|ев|ь)ич(?:а|у|ем|е)?|(?:ов|ев|инич)н(?:а|ы|е|у|ой|ою))|\w{2,}(?:ұлы|қызы)(?:ның|на|н|нда|нан|мен)?|[a-z]{3,}(?:ovich|evich|ovna|evna|uly|kyzy)")
_STRONG_HINT = re.compile("ович|евич|ьич|овн|евн|иничн|ұлы|қызы|ovich|evich|ovna|evna|uly|kyzy")
_SURNAME_ENDS = ("ов", "ова", "ев", "ева", "ёв", "ёва", "ин", "ина", "ын", "ына", "ий", "ая", "ко", "ич", "ук", "юк", "ян", "ov", "va", "ev", "ky", "ya", "ko")
_CASES = re.compile(r"(?<=..)(?:[аяуюыиеёойь]+|[аяуюыиеёойь]*[оеё]м)$")


def _forms(name: str, kind: str) -> set[str]:
    """The case forms of a given name."""
    if kind.startswith("en"):
        return set()
    if kind.startswith("kz"):
        return {name + e for e in "ның нің дың дің тың тің ға ге қа ке ны ні ды ді ты ті да де та те дан ден тан тен нан нен мен пен бен".split()}
    stem = {"павел": "павл", "пётр": "петр"}.get(name, name)
    if name.endswith("ия"):
        return {name[:-1] + e for e in ("и", "ю", "ей")}
    if name[-1] in "ая":
        hard = "и" if name[-1] == "я" or name[-2] in "гкхжчшщ" else "ы"
        return {name[:-1] + e for e in ((hard, "е", "у", "ой") if name[-1] == "а" else (hard, "е", "ю", "ей"))}
    if name[-1] in "йь":
        return {name[:-1] + e for e in ("я", "ю", "ем", "е", "и")}
    return {stem + e for e in ("а", "у", "ом", "е")} if name[-1] not in "еиоуыэюёʼ" and kind == "ru_m" else set()


_LIKE_NAME = re.compile(r"[^\W\d_]{2,}(?:-[^\W\d_]{2,})?")
_TOKEN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_NOT = frozenset("тағы опять снова again и да но а в на с к у о и ещё уже the and is was has had it i he she my our тоже ещё мен және деген екен болды үшін сосын тек там это ведёт принёс сказал зовут привет say hi to by аты тұр плюс plus thanks спасибо рақмет listen guys just on in at от за про под".split())


NOMINATIVE = {f: n for n, kind in GIVEN.items() for f in _forms(n, kind) if f not in GIVEN and f not in _NOT}
INFLECTED = {f: GIVEN[n] for f, n in NOMINATIVE.items()}
#: Surnames in all cases, beside a capital inside a sentence.
_INFLECTED_SURNAME = re.compile(r"[а-яёәіңғқөұүһ-]{2,}(?:(?:ов|ев|ёв|ин|ын)(?:а|у|ым|е|ой|ою|ы|тың|тің|қа|ке|ті|ты|пен|та|те|тан|тен)?|[сц]к(?:ий|ая|ого|ому|им|ом|ой|ую|ою)|енко|чук|юк|ян)|[a-z-]{3,}(?:ov|ova|ev|eva|sky|skaya|enko)")


def _base(surname: str) -> str:
    """A surname's key: masculine nominative, where its ending tells."""
    m = re.fullmatch(r"(.{2,}(?:ов|ев|ёв|ин|ын))(?:а|у|ым|е|ой|ою)?|(.{2,}[сц]к)(?:ий|ая|ого|ому|им|ом|ой|ую|ою)", surname)
    return surname if not m else m[1] or m[2] + "ий"


def _capital(w: str) -> bool:
    return w[0].isupper()


def _names(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, key, certain) of the names of persons; a given name alone is none.

    The key is that of the surname, or of a given name that the lists lack: the collection confirms either.
    """
    toks = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
    n, out, i = len(toks), [], 0
    maybe: list[tuple[int, int, str, bool]] = []  # with an unlisted given name that other texts must confirm
    hint = _STRONG_HINT.search(text.lower()) is not None

    def gap(a: int, b: int) -> str:
        return text[toks[a][1] : toks[b][0]]

    def initial(k: int) -> bool:
        return 0 <= k < n and len(toks[k][2]) == 1 and text[toks[k][1] : toks[k][1] + 1] == "."

    def given(k: int) -> bool:
        return 0 <= k < n and (toks[k][2].lower() in GIVEN or toks[k][2].lower() in INFLECTED)

    def strong(k: int) -> bool:
        return hint and 0 <= k < n and bool(_STRONG.fullmatch(toks[k][2].lower()))

    def unlisted(k: int) -> bool:
        """Whether a token may be a given name that the lists lack."""
        return 0 <= k < n and len(toks[k][2]) > 2 and toks[k][2].lower() not in _NOT and not given(k) and not strong(k) and bool(_LIKE_NAME.fullmatch(toks[k][2]))

    def alike(a: int, b: int) -> bool:
        """Neighbours in the same letter case."""
        return gap(a, b) == " " and _capital(toks[a][2]) == _capital(toks[b][2])

    def begins(k: int) -> bool:
        return k == 0 or bool(re.search(r"[^\s,]", gap(k - 1, k)) or "\n" in gap(k - 1, k))

    def named(k: int) -> str:
        return "given:" + _CASES.sub("", toks[k][2].lower())

    def suffix(k: int) -> bool:
        return 0 <= k < n and bool(_SURNAME.fullmatch(toks[k][2].lower()))

    def certain_pair(a: int, b: int) -> bool:
        """Whether two capitals inside a sentence are a given name and a surname: by its suffix, or by what stands before."""
        first = toks[a][2].lower()
        if first.startswith(HEADS) or first.endswith(("ский", "ская", "ское", "ного", "ной", "вая", "ная", "ное", "вое", "ный", "вый")):
            return False
        if a and toks[a - 1][2].lower() in ROLES and re.fullmatch(r"\.? ", gap(a - 1, a)):
            return surname(b, True) > 0
        if begins(a):
            return False
        return not _capital(toks[a - 1][2]) and not toks[a - 1][2].lower().startswith(HEADS) and bool(_INFLECTED_SURNAME.fullmatch(toks[b][2].lower()))

    def surname(k: int, with_case: bool) -> int:
        """2: certainly, 1: perhaps, 0: no."""
        if not 0 <= k < n:
            return 0
        w = toks[k][2]
        low = w.lower()
        if len(w) < 3 or low in _NOT or low in GIVEN or _capital(w) and low in INFLECTED or not _LIKE_NAME.fullmatch(w):
            return 0
        if _SURNAME.fullmatch(low) and (_capital(w) or not with_case):
            return 2
        return 2 if _capital(w) and with_case and not w.isupper() else 1

    while i < n:
        start, stop, w = toks[i]
        if given(i):
            cap = _capital(w)
            a, b, key, sure = i, i, "", False
            nxt = i + 1
            if nxt < n and gap(i, nxt).isspace() and "\n" not in gap(i, nxt) and (_PATRONYMIC.fullmatch(toks[nxt][2].lower()) or strong(nxt)):
                b, sure = nxt, True
                nxt += 1
            elif initial(nxt) and gap(i, nxt) == " " and nxt + 1 < n and re.fullmatch(r"\.\s?", gap(nxt, nxt + 1)) and surname(nxt + 1, True):
                b, sure, key = nxt + 1, True, toks[nxt + 1][2].lower()
                nxt += 2
            if not key and nxt < n and gap(nxt - 1, nxt) == " " and (k := surname(nxt, cap)) and not (sure and k < 2):
                nextgiven = given(nxt + 1) and gap(nxt, nxt + 1) in (" ", ", ")
                prev = surname(i - 1, cap) if i and gap(i - 1, i) in (" ", ", ") and (not out or out[-1][1] <= toks[i - 1][0]) else 0
                if not (prev == 2 and k == 1) and not (nextgiven and prev):
                    b, key, sure = nxt, toks[nxt][2].lower(), sure or k == 2
            if not key and i and gap(i - 1, i) in (" ", ", ", ",") and (not out or out[-1][1] <= toks[i - 1][0]):
                k = surname(i - 1, cap)
                # A capital may only begin a sentence ("Слушайте, Тимур"): without a suffix the list decides.
                if k == 2 and not suffix(i - 1) and (gap(i - 1, i) != " " or not cap):
                    k = 1
                if k and not (sure and k < 2 and b > i and not suffix(i - 1)):
                    a, key, sure = i - 1, toks[i - 1][2].lower(), sure or k == 2
            if w.lower() in INFLECTED and not cap and not (nxt > i + 1):
                sure = False  # a form of a given name may be another word
            if b > i or a < i:
                out.append((toks[a][0], toks[b][1], key, sure))
                i = b + 1
                continue
        elif initial(i):
            # initials before or behind a surname
            j = i
            while initial(j + 1) and re.fullmatch(r"\.\s?", gap(j, j + 1)) and j - i < 2:
                j += 1
            end = toks[j][1] + 1
            before = surname(i - 1, True) if i and gap(i - 1, i) == " " and (not out or out[-1][1] <= toks[i - 1][0]) else 0
            behind = surname(j + 1, True) if j + 1 < n and re.fullmatch(r"\.\s?", gap(j, j + 1)) else 0
            upper = all(_capital(toks[k][2]) for k in range(i, j + 1))
            pick = None
            # "Surname A. B." before "A. B. Surname", unless only the latter has a surname's suffix.
            if before and (before == 2 and not (suffix(j + 1) and not suffix(i - 1)) or not behind):
                pick = (toks[i - 1][0], end, toks[i - 1][2].lower(), bool(before == 2 and upper and (suffix(i - 1) or j > i)))
            elif behind:
                pick = (start, toks[j + 1][1], toks[j + 1][2].lower(), bool(behind == 2 and upper and (suffix(j + 1) or j > i)))
            if pick:
                out.append(pick)
                while i < n and toks[i][0] < pick[1]:
                    i += 1
                i = max(i, j + 1)
                continue
            i = j
        elif strong(i + 1) and unlisted(i) and alike(i, i + 1):
            a, b = i, i + 1
            if i + 2 < n and alike(i + 1, i + 2) and suffix(i + 2) and not given(i + 2):
                b = i + 2
            elif i and alike(i - 1, i) and suffix(i - 1) and not given(i - 1) and (not out or out[-1][1] <= toks[i - 1][0]):
                a = i - 1
            # A capital may only begin a sentence ("Вчера Петровна"): a surname or another text decides.
            out.append((toks[a][0], toks[b][1], named(i), _capital(w) and (b > i + 1 or a < i or not begins(i))))
            i = b + 1
            continue
        elif i and _capital(w) and unlisted(i - 1) and alike(i - 1, i) and not w.isupper() and len(w) > 3 and certain_pair(i - 1, i) and (not out or out[-1][1] <= toks[i - 1][0]):
            a, b = i - 1, i
            if i + 1 < n and alike(i, i + 1) and (_PATRONYMIC.fullmatch(toks[i + 1][2].lower()) or strong(i + 1)):
                b = i + 1
            out.append((toks[a][0], toks[b][1], named(i - 1), True))
            i = b + 1
            continue
        elif w.lower().endswith(_SURNAME_ENDS) and suffix(i) and not given(i) and len(w) > 3:
            if i and unlisted(i - 1) and alike(i - 1, i):
                maybe.append((toks[i - 1][0], stop, named(i - 1), False))
            if unlisted(i + 1) and alike(i, i + 1) and not strong(i + 2):
                maybe.append((start, toks[i + 1][1], named(i + 1), False))
        i += 1
    out = [(a, b, key if key.startswith("given:") else _base(key), sure) for a, b, key, sure in out]
    return out + [x for x in maybe if all(x[1] <= o[0] or x[0] >= o[1] for o in out)]


def _digits(s: str) -> str:
    return re.sub(r"\D", "", re.sub("[OoОо]", "0", s))


#: What every ``_AT`` has: the sign, a bracket, or a word for the dot behind it.
_AT_SIGNS = ("@", "(", "[", "dot", "точка", "нүкте")
_DIGIT, _RUN = re.compile(r"\d"), re.compile("[0-9OoОо]{6}")


def detect(text: str) -> list[tuple[str, int, int, str, bool]]:
    """(kind, start, end, key, certain) in the normalised text, in reading order; only uncertain names may overlap."""
    found: list[tuple[str, int, int, str, bool]] = []

    def take(kind: str, a: int, b: int, key: str, sure: bool = True) -> None:
        nonlocal text
        found.append((kind, a, b, key, sure))
        text = text[:a] + "\x00" * (b - a) + text[b:]

    low = text.lower()
    digit = _DIGIT.search(text) is not None  # addresses and phones have one
    run = _RUN.search(text) is not None  # identity numbers have six in a row
    for m in EMAIL.finditer(text) if any(x in low for x in _AT_SIGNS) else ():
        take("email", m.start(), m.end(), re.sub(r"\s", "", m[0].lower()))
    for p in ADDRESS if digit else ():
        for m in p.finditer(text):
            take("address", m.start(), m.end(), re.sub(r"[\W_]+", " ", m[0].lower()).strip())
    for m in CARD.finditer(text) if run else ():
        take("id_number", m.start(1), m.end(1), _digits(m[1]))
    for m in PERSONAL.finditer(text) if run else ():
        d = _digits(m[0])
        if sum(c.isdigit() for c in m[0]) >= 8 and ("01" <= d[2:4] <= "12" and "01" <= d[4:6] <= "31" or len(m[0]) == 12):
            take("id_number", m.start(), m.end(), d)
    for m in PASSPORT.finditer(text) if run else ():
        if sum(c.isdigit() for c in m[0]) >= 6:
            take("id_number", m.start(), m.end(), m[0][0].upper() + _digits(m[0][1:]))
    for m in PHONE.finditer(text) if digit else ():
        d = _digits(m[0])
        if sum(c.isdigit() for c in m[0]) >= 7:
            take("phone", m.start(), m.end(), d[-10:])
    for a, b, key, sure in _names(text):
        found.append(("name", a, b, key, sure))
    return sorted(found, key=lambda x: x[1])


_ITEMS = "id long, kind string, start int, stop int, key string, certain boolean, entity string"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            norm, at = align(t)
            for kind, a, e, key, sure in detect(norm):
                rows.append((i, kind, at[a] if at else a, at[e - 1] + 1 if at else e, key, sure, norm[a:e]))
        cols = list(zip(*rows)) if rows else [[]] * 7
        types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["id", "kind", "start", "stop", "key", "certain", "entity"])


def items(texts: DataFrame, least: int = 2) -> DataFrame:
    """Items of personal information in ``id long, text string``: ``id, kind, start, stop, key, entity``.

    ``start`` and ``stop`` count characters of the original text. Null and empty texts have none. Names that only the
    collection can confirm need their surname in at least ``least`` certain names of different texts. Ids are taken to be
    unique; rows with repeated ids are searched each.
    """
    found = materialize(texts.where(F.col("text").isNotNull()).mapInArrow(_find, _ITEMS), "pii")
    known = found.where("kind = 'name' AND certain AND key <> ''").groupBy("key").agg(F.count_distinct("id").alias("n")).where(F.col("n") >= least).select("key")
    sure = found.where("certain")
    perhaps = found.where("NOT certain").join(known, "key", "left_semi").select(*sure.columns)
    ahead = F.max("stop").over(Window.partitionBy("id").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    perhaps = perhaps.withColumn("ahead", ahead).where("ahead IS NULL OR ahead <= start").drop("ahead")
    return sure.unionByName(perhaps).drop("certain")


def occurrences(found: DataFrame) -> DataFrame:
    """``delivery_id, kind, occurrence``: items of one kind in one text numbered in reading order."""
    n = F.row_number().over(Window.partitionBy("id", "kind").orderBy("start", "stop"))
    return found.select(F.col("id").alias("delivery_id"), "kind", n.cast("int").alias("occurrence"))


# --- replacement ---------------------------------------------------------------------------------------------------


def _keyed(key: bytes, *parts: str) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha256).digest()[:8], "big")


def _permute(key: bytes, digits: str) -> str:
    """A keyed permutation of the numbers with as many digits (four Feistel rounds on decimal halves)."""
    n = len(digits)
    if n < 2:
        return str(((int(digits or 0) + _keyed(key, "d")) % 10)) if digits else digits
    h = n // 2
    a, b = digits[:h], digits[h:]
    for r in range(4):
        f = _keyed(key, str(r), str(n), b) % 10 ** len(a)
        a, b = b, str((int(a) + f) % 10 ** len(a)).zfill(len(a))
    return a + b


def _number(key: bytes, digits: str) -> str:
    """A keyed permutation of the numbers with as many digits that do not begin with a zero; others stay among theirs."""
    zero, out = digits[0] == "0", _permute(key, digits)
    while (out[0] == "0") != zero:
        out = _permute(key, out)
    return out


def _swap(key: bytes, pool: list[str], member: str) -> str:
    """A keyed permutation of a list."""
    unique = sorted(set(pool))
    return sorted(unique, key=lambda x: _keyed(key, "swap", x))[unique.index(member)]


def _case(like: str, word: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


_LISTS = {"ru_f": GIVEN_RU_F, "ru_m": GIVEN_RU_M, "kz_f": GIVEN_KZ_F, "kz_m": GIVEN_KZ_M, "en_f": GIVEN_EN_F, "en_m": GIVEN_EN_M}
_LETTERS = {"en": "abcdefghijklmnopqrstuvwxyz", "ru": "абвгдежзиклмнопрстуфхцчшэюяёйәіңғқөұүһ"}
#: Stem and ending of a surname, a patronymic, or a street's name.
_ENDED = re.compile(r"(.{2,}?)((?:ов|ев|ёв|ин|ын)(?:а|у|ым|е|ой|ою|ы)?|[сц]к(?:ий|ая|ого|ому|им|ом|ой|ую|ою)|(?:ов|ев|ь)ич(?:а|у|ем|е)?|(?:ов|ев|инич)н(?:а|ы|е|у|ой|ою)|ұлы|қызы|улы|кызы|ұл|ov|ova|ev|eva|sky|skaya|ovich|evich|ovna|evna)")
_STREET_END = re.compile(r"(.{2,}?)((?:н)?(?:ая|ой|ый|ий|ом|ую))")
# Words of an address that are no name.
_ADDRESS_WORDS = frozenset("ул улица улице улицы улицу пр т проспект проспекте пер переулок переулке дом д кв квартира көшесі к сі даңғылы үй пәтер street st str avenue ave road rd lane ln drive dr flat apt apartment unit house square court бульвар шоссе просп мкр микрорайон blvd boulevard".split())


def _lang(w: str) -> str:
    return "en" if w.isascii() else "kz" if re.search("[әіңғқөұүһ]", w) else "ru"


def _stem(kind: str, word: str) -> tuple[str, str, str]:
    """Type, stem and ending of a word that gets syllables."""
    low = word.lower()
    if kind in ("user", "domain"):
        return kind, re.sub(r"\W+", "", low), ""
    m = (_STREET_END if kind == "street" else _ENDED).fullmatch(low)
    stem, end = m.groups() if m else (low, "")
    return f"{kind}-{_lang(low)}", stem, end


_EMAIL_PARTS = re.compile(r"([^\s@\(\[]+)(.*)", re.DOTALL)
_LABEL = re.compile(r"[a-z0-9-]{2,}(?=\s*[\(\[]?\s*(?:\.|dot|точка|нүкте))", re.IGNORECASE)


def _walk(kind: str, entity: str, key: bytes, syllables) -> str:
    """``entity`` with each of its parts replaced; ``syllables`` gives those of a (kind, word)."""
    if kind in ("phone", "id_number"):
        plain = re.sub("[OoОо]", "0", entity) if kind == "phone" else entity
        digits = re.sub(r"\D", "", plain)
        # The country prefix stays, so that the number keeps its format.
        keep = len(digits) - 9 if kind == "phone" and len(digits) > 9 else 0
        new = iter(digits[:keep] + _permute(key, digits[keep:]))
        return "".join(next(new) if c.isdigit() else c for c in plain)
    if kind == "email":
        user, rest = _EMAIL_PARTS.match(entity).groups()
        at = 0
        for m in _LABEL.finditer(rest):
            if m[0].lower() not in ("dot", "at", "mail"):
                rest, at = rest[: m.start()] + syllables("domain", m[0]) + rest[m.end() :], 1
            if at:
                break
        return syllables("user", user) + rest

    def word(m: re.Match) -> str:
        w, low = m[0], m[0].lower()
        if w.isdigit():
            return _number(key, w)
        if kind == "address":
            return w if low in _ADDRESS_WORDS or len(w) < 2 else syllables("street", w)
        if len(w) == 1:
            letters = _LETTERS["en" if low.isascii() else "ru"]
            return _case(w + "x", _swap(key, list(letters), low))[:1] if low in letters else w
        base = low if low in GIVEN else NOMINATIVE.get(low)
        if base:
            other = _swap(key, _LISTS[GIVEN[base]], base)
            return _case(w, other + (low[len(base) :] if low.startswith(base) else ""))
        return syllables("name", w)

    return re.sub(r"\d+|[^\W\d_]+", word, entity)


def _syllables(lang: str, n: int, least: int) -> str:
    """A number in syllables, ``least`` of them at least; one to one, as all syllables have three letters."""
    s, out = SYLLABLES[lang], []
    while n or len(out) < least:
        n, d = divmod(n, len(s))
        out.append(s[d])
    return "".join(out)


def _place(key: bytes, kind: str, stem: str) -> int:
    """Where the hash puts a stem among all words of three syllables."""
    s = SYLLABLES[kind.partition("-")[2] or "en"]
    return _keyed(key, kind, stem) % len(s) ** 3


def parts(kind: str, entity: str, key: bytes) -> list[tuple[str, str, int]]:
    """Type, stem and place of the parts of an item that get syllables."""
    out = []

    def note(k: str, w: str) -> str:
        t, stem, _ = _stem(k, w)
        out.append((t, stem, _place(key, t, stem)))
        return w

    _walk(kind, entity, key, note)
    return out


def surrogate(kind: str, entity: str, key: bytes, clashes: dict[tuple[str, str], int] | None = None) -> str:
    """A replacement of the same kind and format; ``clashes`` numbers the stems that share their place with others."""

    def word(k: str, w: str) -> str:
        t, stem, end = _stem(k, w)
        lang, n = t.partition("-")[2] or "en", (clashes or {}).get((t, stem), 0)
        return _case(w, _syllables(lang, _place(key, t, stem), 3) + (_syllables(lang, n, 1) if n else "") + end)

    return _walk(kind, entity, key, word)


def _part_rows(secret: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, e, t, s, n) for k, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for t, s, n in parts(k, e, secret)]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()))], names=["kind", "entity", "type", "stem", "place"])

    return run


def _render(secret: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [surrogate(k, e, secret, {(x["type"], x["stem"]): x["n"] for x in c or ()}) for k, e, c in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["kind", "entity", "surrogate"])

    return run


def surrogates(found: DataFrame, secret: bytes) -> DataFrame:
    """``kind, entity, surrogate`` for every distinct spelling in ``kind, entity``.

    Stems of one type at one place of the hash are numbered in the order of another keyed hash; all but the first get
    their number in further syllables. So different stems have different surrogates, and equal ones equal ones, without
    any rounds. Groups at one place are small: the hash spreads the stems over some 6,000 (Kazakh) to 39,000 places.
    """
    spellings = found.select("kind", "entity").distinct()
    part = materialize(spellings.mapInArrow(_part_rows(secret), "kind string, entity string, type string, stem string, place long"), "pii-parts")
    order = Window.partitionBy("type", "place").orderBy(F.sha2(F.concat(F.lit(secret.hex()), "stem"), 256))
    clash = part.select("type", "stem", "place").distinct().withColumn("n", F.row_number().over(order) - 1).where("n > 0").select("type", "stem", "n")
    told = part.select("kind", "entity", "type", "stem").join(clash, ["type", "stem"]).groupBy("kind", "entity").agg(F.collect_list(F.struct("type", "stem", "n")).alias("clashes"))
    return spellings.join(told, ["kind", "entity"], "left").select("kind", "entity", "clashes").mapInArrow(_render(secret), "kind string, entity string, surrogate string")


def session_key(spark: SparkSession) -> bytes:
    """The key of ``weftline.surrogate.key``; where none is set, a new random one, so that nobody can recompute surrogates."""
    given = spark.conf.get("weftline.surrogate.key", None)
    return given.encode() if given else secrets.token_bytes(32)


def protected(texts: DataFrame, secret: bytes) -> DataFrame:
    """``items`` with the ``surrogate`` of each; the spellings' table is joined, not broadcast."""
    found = materialize(items(texts), "pii-items")
    return found.join(surrogates(found, secret), ["kind", "entity"])


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, sur = [], []
        for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if not spans:
                out.append(t)
                sur.append(t)
                continue
            for field, target in (("place", out), ("surrogate", sur)):
                parts, at = [], 0
                for s in sorted(spans, key=lambda s: s["start"]):
                    parts += [t[at : s["start"]], s[field]]
                    at = s["stop"]
                target.append("".join(parts) + t[at:])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(sur, pa.string())], names=["id", "redacted", "surrogate"])


def replace_items(texts: DataFrame, secret: bytes) -> DataFrame:
    """``id, redacted, surrogate`` for every row of ``id, text``: typed placeholders, and surrogates, in their place.

    Placeholders number the different entities of a kind within a text, so equal ones get the same number. Texts without
    items and null texts come out as they are.
    """
    ident = F.when(F.col("kind").isin("phone", "id_number"), F.col("key")).otherwise(F.trim(F.regexp_replace(F.lower("entity"), r"[^\p{L}\p{N}]+", " ")))
    named = protected(texts, secret).withColumn("ident", ident)
    number = F.dense_rank().over(Window.partitionBy("id", "kind").orderBy("first", "ident"))
    first = named.withColumn("first", F.min("start").over(Window.partitionBy("id", "kind", "ident"))).withColumn("place", F.concat(F.lit("["), F.upper("kind"), F.lit("_"), number, F.lit("]")))
    spans = first.groupBy("id").agg(F.collect_list(F.struct("start", "stop", "place", "surrogate")).alias("spans"))
    joined = texts.join(spans, "id", "left").select("id", "text", "spans")
    return joined.mapInArrow(_replace, "id long, redacted string, surrogate string")

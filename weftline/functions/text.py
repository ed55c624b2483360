"""Column functions on text: tokens, stems, keys, classification flags, style and features.

Everything is built from built-in functions, so it stays in the JVM; patterns are fused into one alternation each.
Word boundaries are spelt out (neither letter, digit nor underscore), since ``\\b`` differs between engines.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(words: list[str]) -> str:
    """Pattern: one of the words as a whole word."""
    return L.LEFT + "(?:" + "|".join(re.escape(w).replace("\\ ", " ").replace("\\-", "-") for w in words) + ")" + L.RIGHT


def parts(words: list[str]) -> str:
    """Pattern: one of the words anywhere."""
    return "|".join(re.escape(w).replace("\\ ", " ").replace("\\-", "-") for w in words)


def normalize(t: Column | str) -> Column:
    """Without zero-width spaces, blanks as one space, trimmed."""
    return F.trim(F.regexp_replace(F.replace(col(t), F.lit("​"), F.lit("")), L.BLANK + "+", " "))


def split_words(t: Column | str) -> Column:
    """Parts between blanks."""
    return F.filter(F.split(col(t), L.BLANK + "+"), lambda x: x != "")


def tokens(t: Column | str) -> Column:
    """Runs of the alphabet's letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(col(t)), F.lit(L.WORD), F.lit(0))


def stems(words: Column) -> Column:
    """Distinct prefixes of five letters of the words that are not stop words."""
    stop = F.array(*[F.lit(w) for w in L.STOPWORDS])
    return F.array_distinct(F.transform(F.filter(words, lambda w: (F.length(w) > 1) & ~F.array_contains(stop, w)), lambda w: F.substring(w, 1, 5)))


def dedupe_key(t: Column | str) -> Column:
    return F.regexp_replace(F.lower(col(t)), "[^a-zа-яёәіңғқөұүһ0-9]", "")


def grams(words: Column, n: int = 5) -> Column:
    """Distinct runs of ``n`` words; none if there are fewer."""
    return F.when(F.size(words) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " ")))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Zero if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector with length one; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / F.when(norm > 0, norm).otherwise(1.0))


def share(t: Column) -> Column:
    """Letters and digits among the characters."""
    return F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]", "")) / F.length(t)


# --- classification ---------------------------------------------------------------------------------------------------


def flags(t: Column | str) -> dict[str, Column]:
    """The eight reasons, each a boolean, on normalised text; false for null."""
    t = col(t)
    low = F.lower(t)
    out = {
        "too_short": (F.length(F.trim(t)) < 15) | (F.size(split_words(t)) < 3),
        "noise": t.rlike(r"(.)\1{7,}") | ((F.length(t) > 0) & (share(t) < 0.35)),
        "contact_information": low.rlike("|".join(L.CONTACT) + "|" + L.LEFT + "(?:" + L.CONTACT_WORDED[0] + "|" + L.EMAIL + L.RIGHT + ")"),
        "personal_identification_request": low.rlike(whole(L.IDENTIFICATION_SINGLE + L.IDENTIFICATION_PHRASES) + "|" + L.LEFT + "(?:" + "|".join(L.IDENTIFICATION_FREE) + ")" + L.RIGHT),
        "targeted_person_reference": low.rlike(parts(L.PERSON_PARTS)) & low.rlike(parts(L.TARGETING_PARTS)),
        "sensitive_content": low.rlike(parts(L.SENSITIVE_PARTS)),
        "targeted_harassment": low.rlike(whole(L.HARASSMENT_WHOLE) + "|" + L.LEFT + "(?:" + "|".join(L.HARASSMENT_PREFIX) + ")"),
        "advertisement": low.rlike(parts(L.ADVERTISEMENT_PARTS)),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}


def unfit_exemplar(t: Column | str) -> Column:
    """Whether a post addresses someone, swears, belongs to a series, or is about local specifics."""
    low = F.lower(col(t))
    begins = "(?:" + "|".join(L.PROFANITY_BEGINS + L.SERIES + L.LOCAL_BEGINS) + ")"
    return low.rlike("|".join([parts(L.PROFANITY_PARTS + L.LOCAL_PARTS), whole(L.DIRECT_ADDRESS + L.LOCAL_WHOLE), L.LEFT + begins, "(?:" + "|".join(L.LOCAL_ENDS) + ")" + L.RIGHT]))


def reasons(t: Column | str) -> Column:
    """The reasons that hold, in their fixed order."""
    f = flags(t)
    return F.filter(F.array(*[F.when(f[r], F.lit(r)) for r in L.REASONS]), lambda x: x.isNotNull())


def style_score(t: Column | str) -> Column:
    t = col(t)
    own = F.transform(split_words(t), lambda w: F.regexp_replace(F.lower(w), r"^[.,!?]+|[.,!?]+$", ""))
    i = lambda c, n: F.when(c, n).otherwise(0)
    return (
        i(F.length(t).between(15, 500), 2)
        + i(t.contains("?"), 2)
        + i(t.rlike(L.EMOJI_NARROW), 1)
        + i(t.rlike(L.CYRILLIC_NO_YO) & t.rlike("[A-Za-z]"), 2)
        + i(reduce(lambda a, b: a | b, [t.contains(x) for x in L.LAUGHING]), 1)
        + i(F.arrays_overlap(own, F.array(*[F.lit(p) for p in L.PRONOUNS])), 1)
    )


def classification(found: Column, style: Column) -> Column:
    """EXCLUDE with any reason; else by style."""
    return F.when(F.size(found) > 0, "EXCLUDE").when(style >= 2, "SAFE_STYLE_REFERENCE").otherwise("REVIEW")


# --- style ----------------------------------------------------------------------------------------------------------


def script(t: Column | str, latin: str = "latin", raw: bool = False) -> Column:
    """mixed, cyrillic, Latin's label, or other; the Cyrillic class has no yo."""
    t = col(t)
    cyr, lat = t.rlike(L.CYRILLIC_NO_YO), t.rlike("[A-Za-z]")
    return F.when(cyr & lat, "mixed").when(cyr, "cyrillic").when(lat, latin).otherwise("other")


def word_language(t: Column | str) -> Column:
    """ru, kz, ru_kz, ru_en or en by shares of words."""
    ws = tokens(t)
    kz = F.array(*[F.lit(w) for w in L.KAZAKH_WORDS])
    cyr = F.filter(ws, lambda w: w.rlike("[а-яёәіңғқөұүһ]"))
    latin = F.size(F.filter(ws, lambda w: w.rlike("^[a-z]{2,}$"))) > 0
    hits = F.size(F.filter(cyr, lambda w: w.rlike(L.KAZAKH_LETTERS) | F.array_contains(kz, w)))
    part = hits / F.greatest(F.size(cyr), F.lit(1))
    return F.when(F.size(cyr) == 0, F.when(latin, "en").otherwise("ru")).when(latin, "ru_en").when(part >= 0.45, "kz").when((part >= 0.15) | (hits >= 2), "ru_kz").otherwise("ru")


def post_format(t: Column | str) -> Column:
    t = col(t)
    n = F.size(split_words(t))
    return F.when(t.contains("?"), F.when(n <= 20, "short_question").otherwise("question")).when(n <= 8, "short_statement").when(n >= 80, "long_story").otherwise("general_statement")


def raw_format(t: Column | str) -> Column:
    t = F.trim(col(t))
    n = F.size(split_words(t))
    return F.when(t.contains("?"), "question").when(F.lower(t).rlike("^(?:1|2|3|а|б)[.)-]"), "poll_or_options").when(n <= 8, "short_statement").when(n >= 80, "long_story").otherwise("general_statement")


def emoji_runs(t: Column | str) -> Column:
    return F.size(F.regexp_extract_all(col(t), F.lit(L.EMOJI_WIDE), F.lit(0)))


def question_type(t: Column | str) -> Column:
    t = col(t)
    first = F.regexp_replace(F.coalesce(F.get(split_words(F.lower(t)), F.lit(0)), F.lit("")), "[^a-zа-яёәіңғқөұүһ]", "")
    starts = F.create_map(*[F.lit(x) for kv in L.QUESTION_STARTS.items() for x in kv])
    return F.when(~t.contains("?"), "not_question").otherwise(F.coalesce(F.try_element_at(starts, first), F.lit("other_question")))


def listed(t: Column | str, words: list[str]) -> Column:
    """The words of the list that the text has, in the list's order; most texts have none, which one pattern tells."""
    low = F.lower(col(t))
    each = F.filter(F.array(*[F.when(low.rlike(whole([w])), F.lit(w)) for w in words]), lambda x: x.isNotNull())
    return F.when(low.rlike(whole(words)), each).otherwise(F.array().cast("array<string>"))


def topics(t: Column | str) -> Column:
    """All topics with a keyword in the text, or ``other``."""
    low = F.lower(col(t))
    hit = F.filter(F.array(*[F.when(low.rlike(whole(ws.split())), F.lit(k)) for k, ws in L.TOPICS.items()]), lambda x: x.isNotNull())
    return F.when(low.rlike(whole([w for ws in L.TOPICS.values() for w in ws.split()])), hit).otherwise(F.array(F.lit("other")))


def count_words(t: Column | str, words: list[str]) -> Column:
    """Entries of the list that the text has; an entry listed twice counts twice."""
    low = F.lower(col(t))
    return reduce(lambda a, b: a + b, [low.rlike(whole([w])).cast("int") for w in words])


def bucket(n: Column, bounds: list[int]) -> Column:
    """The first bound not exceeded, as its place; beyond all: their number."""
    out = None
    for i, b in enumerate(bounds):
        out = F.when(n <= b, i) if out is None else out.when(n <= b, i)
    return out.otherwise(len(bounds))


# --- features ---------------------------------------------------------------------------------------------------------


def features(t: Column | str) -> dict[str, Column]:
    t = col(t)
    low, ws = F.lower(t), tokens(t)
    hits = F.filter(F.array(*[F.when(low.rlike(p), F.lit(k)) for k, p in L.PHRASES.items()]), lambda x: x.isNotNull())
    q = t.contains("?")
    sentences = F.size(F.filter(F.split(t, "[.!?…]+" + L.BLANK + "*"), lambda s: F.trim(F.regexp_replace(s, L.BLANK, " ")) != ""))
    ending = F.when(t.endswith("?"), "q").when(t.endswith("...") | t.endswith("…"), "ellipsis").when(F.right(t, F.lit(2)).rlike(L.EMOJI_GENERATOR), "emoji").when((t == "") | F.right(t, F.lit(1)).rlike(r"[\p{L}\p{N})]"), "bare").otherwise("stop")
    return {
        "length": F.length(t),
        "lenband": bucket(F.length(t), L.LENGTH_BANDS),
        "is_question": q,
        "advice": F.arrays_overlap(hits, F.array(F.lit("what_to_do"), F.lit("how_to_verb"))) | low.rlike(L.ADVICE) | (F.array_contains(hits, "dont_know_if") & q),
        "patterns": F.array_join(hits, ","),
        "opener1": F.coalesce(F.substring(F.get(ws, F.lit(0)), 1, 4), F.lit("?")),
        "opener2": F.array_join(F.transform(F.slice(ws, 1, 2), lambda w: F.substring(w, 1, 4)), " "),
        "ending": ending,
        "casing": F.when(t.rlike(r"^\p{Ll}"), "lower").otherwise("upper"),
        "shape": F.concat(F.lit("s"), F.least(sentences, F.lit(3)), F.when(low.rlike(whole(L.FIRST_PERSON_FEATURE)), "_fp").otherwise("_np")),
        "tells": F.regexp_count(low, F.lit(L.TELLS)) + F.when((F.length(t) < 150) & (F.length(t) - F.length(F.replace(t, F.lit(","), F.lit(""))) >= 3), 1).otherwise(0),
        "emoji": t.rlike(L.EMOJI_GENERATOR),
    }

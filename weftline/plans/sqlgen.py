"""Fragments of DuckDB SQL that the oracles share; written apart from the Column functions they check."""

from __future__ import annotations

from ..functions import lexicons as L


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q(pattern)})"


def whole(words: list[str]) -> str:
    return L.LEFT + "(?:" + "|".join(words) + ")" + L.RIGHT


def arr(words: list[str]) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


NORM = f"trim(regexp_replace(replace(text, chr(8203), ''), {q(L.BLANK + '+')}, ' ', 'g'))"
#: Posts with normalised text, in order of arrival.
POSTS = f"posts AS (SELECT delivery_id, source, {NORM} AS t FROM raw_telegram_posts WHERE text IS NOT NULL)"


def words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, {q(L.BLANK + '+')}), lambda w: w <> '')"


def tokens(t: str) -> str:
    return f"regexp_extract_all(lower({t}), {q(L.WORD)})"


def stems(ws: str) -> str:
    return f"list_distinct(list_transform(list_filter({ws}, lambda w: len(w) > 1 AND NOT list_contains({arr(L.STOPWORDS)}, w)), lambda w: substr(w, 1, 5)))"


def any_part(t: str, ws: list[str]) -> str:
    return "(" + " OR ".join(f"contains({t}, {q(w)})" for w in ws) + ")"


def pick(pairs: list[tuple[str, str]]) -> str:
    """List of the names whose condition holds."""
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {q(n)} END" for n, c in pairs) + "], lambda x: x IS NOT NULL)"


def flags(t: str = "t") -> list[tuple[str, str]]:
    low = f"lower({t})"
    return [
        ("too_short", f"(len(trim({t})) < 15 OR len({words(t)}) < 3)"),
        ("noise", f"(len(list_filter(range(1, greatest(length({t}) - 6, 1)), lambda i: substr({t}, i::BIGINT, 8) = repeat(substr({t}, i::BIGINT, 1), 8))) > 0 OR (length({t}) > 0 AND length(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) / length({t}) < 0.35))"),
        ("contact_information", "(" + " OR ".join([rx(low, p) for p in L.CONTACT] + [rx(low, L.LEFT + L.CONTACT_WORDED[0]), rx(low, L.LEFT + L.EMAIL + L.RIGHT)]) + ")"),
        ("personal_identification_request", "(" + " OR ".join([rx(low, whole(L.IDENTIFICATION_SINGLE)), rx(low, whole(L.IDENTIFICATION_PHRASES)), *(rx(low, L.LEFT + p + L.RIGHT) for p in L.IDENTIFICATION_FREE)]) + ")"),
        ("targeted_person_reference", f"({any_part(low, L.PERSON_PARTS)} AND {any_part(low, L.TARGETING_PARTS)})"),
        ("sensitive_content", any_part(low, L.SENSITIVE_PARTS)),
        ("targeted_harassment", f"({rx(low, whole(L.HARASSMENT_WHOLE))} OR {rx(low, L.LEFT + '(?:' + '|'.join(L.HARASSMENT_PREFIX) + ')')})"),
        ("advertisement", any_part(low, L.ADVERTISEMENT_PARTS)),
    ]


def unfit_exemplar(t: str = "t") -> str:
    low = f"lower({t})"
    tests = [any_part(low, L.PROFANITY_PARTS), any_part(low, L.LOCAL_PARTS), rx(low, whole(L.DIRECT_ADDRESS)), rx(low, whole(L.LOCAL_WHOLE))]
    tests += [rx(low, L.LEFT + w) for w in L.PROFANITY_BEGINS + L.SERIES + L.LOCAL_BEGINS] + [rx(low, w + L.RIGHT) for w in L.LOCAL_ENDS]
    return "(" + " OR ".join(tests) + ")"


def style(t: str = "t") -> str:
    own = f"list_transform({words(t)}, lambda w: trim(lower(w), '.,!?'))"
    return (
        f"(CASE WHEN length({t}) BETWEEN 15 AND 500 THEN 2 ELSE 0 END + CASE WHEN contains({t}, '?') THEN 2 ELSE 0 END + CASE WHEN {rx(t, L.EMOJI_NARROW)} THEN 1 ELSE 0 END"
        f" + CASE WHEN {rx(t, L.CYRILLIC_NO_YO)} AND {rx(t, '[A-Za-z]')} THEN 2 ELSE 0 END + CASE WHEN {any_part(t, L.LAUGHING)} THEN 1 ELSE 0 END"
        f" + CASE WHEN list_has_any({own}, {arr(L.PRONOUNS)}) THEN 1 ELSE 0 END)"
    )


def script(t: str = "t", latin: str = "latin") -> str:
    return f"CASE WHEN {rx(t, L.CYRILLIC_NO_YO)} AND {rx(t, '[A-Za-z]')} THEN 'mixed' WHEN {rx(t, L.CYRILLIC_NO_YO)} THEN 'cyrillic' WHEN {rx(t, '[A-Za-z]')} THEN {q(latin)} ELSE 'other' END"


def word_language(t: str = "t") -> str:
    ws = tokens(t)
    cyr = f"list_filter({ws}, lambda w: regexp_matches(w, '[а-яёәіңғқөұүһ]'))"
    latin = f"len(list_filter({ws}, lambda w: regexp_matches(w, '^[a-z]{{2,}}$'))) > 0"
    hits = f"len(list_filter({cyr}, lambda w: regexp_matches(w, {q(L.KAZAKH_LETTERS)}) OR list_contains({arr(L.KAZAKH_WORDS)}, w)))"
    n = f"greatest(len({cyr}), 1)"
    return f"CASE WHEN len({cyr}) = 0 THEN CASE WHEN {latin} THEN 'en' ELSE 'ru' END WHEN {latin} THEN 'ru_en' WHEN {hits} / {n} >= 0.45 THEN 'kz' WHEN {hits} / {n} >= 0.15 OR {hits} >= 2 THEN 'ru_kz' ELSE 'ru' END"


def post_format(t: str = "t") -> str:
    return f"CASE WHEN contains({t}, '?') THEN CASE WHEN len({words(t)}) <= 20 THEN 'short_question' ELSE 'question' END WHEN len({words(t)}) <= 8 THEN 'short_statement' WHEN len({words(t)}) >= 80 THEN 'long_story' ELSE 'general_statement' END"


def raw_format(t: str = "t") -> str:
    return f"CASE WHEN contains({t}, '?') THEN 'question' WHEN {rx(f'lower(trim({t}))', '^(?:1|2|3|а|б)[.)-]')} THEN 'poll_or_options' WHEN len({words(t)}) <= 8 THEN 'short_statement' WHEN len({words(t)}) >= 80 THEN 'long_story' ELSE 'general_statement' END"


def question_type(t: str = "t") -> str:
    first = f"regexp_replace(coalesce(({words(f'lower({t})')})[1], ''), '[^a-zа-яёәіңғқөұүһ]', '', 'g')"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in L.QUESTION_STARTS.items())
    return f"CASE WHEN NOT contains({t}, '?') THEN 'not_question' ELSE CASE {first} {whens} ELSE 'other_question' END END"


def bucket(n: str, bounds: list[int]) -> str:
    return "CASE " + " ".join(f"WHEN {n} <= {b} THEN {i}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds)} END"


def count_words(t: str, ws: list[str]) -> str:
    return "(" + " + ".join(f"CAST({rx(f'lower({t})', whole([w]))} AS INT)" for w in ws) + ")"


def features(t: str = "t") -> dict[str, str]:
    low, ws = f"lower({t})", tokens(t)
    hits = pick([(k, rx(low, p)) for k, p in L.PHRASES.items()])
    sentences = f"len(list_filter(regexp_split_to_array({t}, {q('[.!?…]+' + L.BLANK + '*')}), lambda s: trim(regexp_replace(s, {q(L.BLANK)}, ' ', 'g')) <> ''))"
    return {
        "length": f"length({t})",
        "lenband": bucket(f"length({t})", L.LENGTH_BANDS),
        "is_question": f"contains({t}, '?')",
        "advice": f"(list_has_any({hits}, ['what_to_do', 'how_to_verb']) OR {rx(low, L.ADVICE)} OR (list_contains({hits}, 'dont_know_if') AND contains({t}, '?')))",
        "patterns": f"coalesce(array_to_string({hits}, ','), '')",
        "opener1": f"coalesce(substr(({ws})[1], 1, 4), '?')",
        "opener2": f"coalesce(array_to_string(list_transform(({ws})[1:2], lambda w: substr(w, 1, 4)), ' '), '')",
        "ending": f"CASE WHEN suffix({t}, '?') THEN 'q' WHEN suffix({t}, '...') OR suffix({t}, '…') THEN 'ellipsis' WHEN {rx(f'right({t}, 2)', L.EMOJI_GENERATOR)} THEN 'emoji' WHEN {t} = '' OR {rx(f'right({t}, 1)', '[' + chr(92) + 'p{L}' + chr(92) + 'p{N})]')} THEN 'bare' ELSE 'stop' END",
        "casing": f"CASE WHEN {rx(t, '^' + chr(92) + 'p{Ll}')} THEN 'lower' ELSE 'upper' END",
        "shape": f"'s' || least({sentences}, 3) || CASE WHEN {rx(low, whole(L.FIRST_PERSON_FEATURE))} THEN '_fp' ELSE '_np' END",
        "tells": f"(len(regexp_extract_all({low}, {q(L.TELLS)})) + CASE WHEN length({t}) < 150 AND length({t}) - length(replace({t}, ',', '')) >= 3 THEN 1 ELSE 0 END)",
        "emoji": rx(t, L.EMOJI_GENERATOR),
    }

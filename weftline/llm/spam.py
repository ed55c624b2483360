"""Problem 10: keyword-stuffed and link-list pages.

Method: suffix automata of each page; their repeated maximal substrings (the longest string of a state that occurs
again) say which words of the page are repeated, and that coverage is combined with missing clause structure. A page is
read twice:

* as words: keywords repeat. A word counts as stuffing if a heavy repeated substring covers it (characters times
  occurrences are a good share of the page) and its segment has no clause besides the repeats, or if repeats of any mass
  (strings of several words; single ones where function words are missing) make up its segment, and that is an entry of a
  list, a short line without an end, or says the same words again and again itself;
* as classes, where clauses are missing: links, tags, numbers and runs of other words are a symbol each, so the entries
  of link lists, tag lists and product lists repeat although no word does. Segments with a clause part the sequence.
  Words count as stuffing if a substring of two symbols or more that occurs ``LEAST`` times covers their symbols.

Clause structure is told by function words and verb endings of the three languages. A page is spam if more than half
of its words are stuffing. The automaton of words holds only words that occur twice or more: a word that occurs once is
in no repeated substring, so it only parts the sequence and the result is the same.

Pages are independent: one Arrow pass, no shuffle; memory per task is that of the longest page.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Function words of the three languages.
FUNCTION_WORDS = frozenset(
    """
    а без бы был была было были быть в вам вас ведь весь во вот все всё всегда вы где да даже для до его ещё если есть
    же за зато и из или им их к как какой кто ко когда кому ли меня мне мной мой моя мы на над не него неё нет ни них но
    ну о об он она они оно от перед по под потом потому почему при про раз с сам свой себя сейчас со так такой там тебе
    тебя теперь то тогда того тоже только том тот три ты у уже хотя чего чем через что чтобы эта эти это этот я
    ал ана анау арқылы бар бәрі бері бірақ бір біз біздің болды бойы бойынша деген деп да де дейін едім еді екен емес
    енді ешкім ғана ғой және жоқ үшін кейін кім кімге мен менде мені менің мына не неге немесе о ол онда оны осы
    сен сені сияқты сондықтан сонда сосын соң та тағы те тек туралы түк үшін шейін қайда қалай қашан әлі әрдайым өзі
    a about after again all am an and any are as at be because been before but by can could did do does for from had has
    have he her here him his how i if in instead into is it its just like me my never no not now of on one or our out over
    she should so some that the their them then there they this to too under until up us was we were what when where which
    while who why will with would you your
    """.split()
)
# Endings of finite verbs that mark a clause.
_VERB = re.compile(r"(?:[аяеиоуы]л(?:а|о|и|ся|ась|ось|ись)?|[аеиуюя]ет(?:ся)?|[аяую]т(?:ся)?|ишь|ешь|[дтпрн][ыі]м?|[дт][ыі]|ған|ген|қан|кен|[еа]ді|[ей]мін|[аы]мын)$")
_LINK = r"(?:https?://|www\.)\S+|\b[\w-]+(?:\.[\w-]+)*\.(?:[a-z]{2,12})(?:/[^\s)\]]*)?(?![\w.])"
_TOKEN = re.compile(rf"({_LINK})|(\#\w+)|([^\W_]+)", re.IGNORECASE)
_LABELLED = re.compile(r"\[([^\]\n]*)\]\(([^)\s]*)\)")
#: A repeated string is heavy from so many occurrences and so large a share of the page's characters on.
LEAST, MASS = 3, 0.017
_COMMA = re.compile(r"\s*[,;，、]\s*")
#: A list at commas: entries at least, words of an entry on average and at most (so many may a line of a list have, too).
ENTRIES, SHORT, LONG = 4, 4, 6
#: Ends of sentences, lines and list entries.
_SEGMENT = re.compile(r"\n+|(?<=[.!?…])\s+|\s*[|;•·]\s*|\s+[/—–]\s+")


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
    """Suffix automaton of ``words``; negative words part the sequence.

    Gives, per state, the length of its longest string, its suffix link, the number of its occurrences, and the end
    of one of them; and per word the state of all that stands before it since the last part, with it.
    """
    nxt: list[dict[int, int]] = [{}]
    link, length, count, end = [-1], [0], [0], [-1]
    last, state = 0, [0] * len(words)
    for at, c in enumerate(words):
        if c < 0:
            last = 0
            continue
        p = last
        q = nxt[p].get(c)
        if q is not None:  # only after a part: the string is there already
            if length[q] == length[p] + 1:
                last = q
            else:
                k = len(nxt)
                nxt.append(nxt[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                count.append(0)
                end.append(at)
                link[q] = k
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = k
                    p = link[p]
                last = k
            count[last] += 1
            state[at] = last
            continue
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[p] + 1)
        count.append(1)
        end.append(at)
        while p >= 0:
            d = nxt[p]
            q = d.get(c)
            if q is not None:
                break
            d[c] = cur
            p = link[p]
        if p >= 0:
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                k = len(nxt)
                nxt.append(nxt[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                count.append(0)
                end.append(end[q])
                link[q] = link[cur] = k
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = k
                    p = link[p]
        last = state[at] = cur
    # Occurrences and ends go from long strings to their suffixes.
    for s in sorted(range(1, len(nxt)), key=length.__getitem__, reverse=True):
        p = link[s]
        if p > 0:
            count[p] += count[s]
    return length, link, count, end, state


def covered_words(words: list[int], chars: list[int], least: int, mass: float) -> list[bool]:
    """For each word, whether an occurrence of a heavy repeated maximal substring covers it.

    Heavy: it occurs ``least`` times or more, and its characters times its occurrences reach ``mass``. A state's longest
    string is maximal: with one more word on its left it occurs less often.
    """
    return _covers(words, chars, least, mass)[0]


def _covers(words: list[int], chars: list[int], least: int, mass: float) -> tuple[list[bool], list[bool]]:
    """``covered_words``; and the same for strings of two words and more that occur ``least`` times, of any mass.

    The longest such string that ends at a place is found on the suffix links of the place's state, which the states'
    order by length lets carry down.
    """
    length, link, count, end, state = automaton(words)
    before = [0]
    for c in chars:
        before.append(before[-1] + c)
    reach, phrase = [0] * len(length), [0] * len(length)
    for s in sorted(range(1, len(length)), key=length.__getitem__):
        reach[s], phrase[s] = reach[link[s]], phrase[link[s]]
        if count[s] >= least:
            n, e = length[s], end[s] + 1
            if n > 1:
                phrase[s] = n
            if (before[e] - before[e - n]) * count[s] >= mass:
                reach[s] = n
    out, phrases, left, more = [False] * len(words), [False] * len(words), 0, 0
    for i in range(len(words) - 1, -1, -1):
        if words[i] >= 0:
            left, more = max(left, reach[state[i]]), max(more, phrase[state[i]])
        if left:
            out[i] = True
            left -= 1
        if more:
            phrases[i] = True
            more -= 1
    return out, phrases


def _entries(segment: str) -> list[str]:
    """The entries of a segment that is a list at commas; else the segment."""
    parts = [p for p in _COMMA.split(segment) if p]
    if len(parts) < ENTRIES:
        return [segment]
    sizes = [len(p.split()) for p in parts]
    if sum(sizes) > SHORT * len(parts) or max(sizes) > LONG:
        return [segment]
    words = _TOKEN.findall(segment.lower())
    return parts if sum(w in FUNCTION_WORDS for _, _, w in words) * 4 <= len(words) else [segment]


#: Symbols of the second reading.
LINK, TAG, NUMBER, OTHER = range(4)


def _classes(toks: list[tuple[str, int]]) -> list[tuple[int, int]]:
    """(symbol, words) of an entry: every link and tag by itself, other words and numbers in runs."""
    out: list[tuple[int, int]] = []
    for w, kind in toks:
        s = LINK if kind == 1 else TAG if kind else NUMBER if w.isdigit() else OTHER
        if kind or not out or out[-1][0] != s:
            out.append((s, 1))
        else:
            out[-1] = (s, out[-1][1] + 1)
    return out


def profile(text: str) -> tuple[int, int, int, int]:
    """Words of a page; links and tags; words that repeated maximal substrings cover; words that count as stuffing."""
    segments: list[tuple[list[tuple[str, int]], bool, bool]] = []
    raw: list[tuple[str, bool]] = []
    for s in _SEGMENT.split(text):
        if s:
            parts = _entries(s)
            raw += [(p, len(parts) > 1) for p in parts]
    for s, listed in raw:
        toks = []
        if "](" in s:  # the label of a link belongs to the link
            for m in _LABELLED.finditer(s):
                toks += [(w.lower(), 1) for w in m[1].split()] + [(m[2].lower(), 1)]
            s = _LABELLED.sub(" ", s).strip() or " "
        toks += [(m[0].lower(), 1 if m[1] else 2 if m[2] else 0) for m in _TOKEN.finditer(s)]
        if toks:
            segments.append((toks, s[-1] in ".!?…)", listed))
    flat = [t for toks, _, _ in segments for t in toks]
    n = len(flat)
    if not n:
        return 0, 0, 0, 0
    freq = Counter(w for w, _ in flat)
    names: dict[str, int] = {}
    seq, unique = [], -1
    for w, kind in flat:
        if freq[w] > 1 and not kind:
            seq.append(names.setdefault(w, len(names)))
        else:
            seq.append(unique)
            unique -= 1
    chars = [len(w) for w, _ in flat]
    cover, phrases = _covers(seq, chars, LEAST, MASS * sum(chars)) if names else ([False] * n, [False] * n)
    links = stuffed = covered = 0
    at = 0
    classes: list[tuple[int, int]] = []
    for toks, closed, listed in segments:
        m = len(toks)
        special = sum(k > 0 for _, k in toks)
        func = sum(w in FUNCTION_WORDS for w, k in toks if not k)
        rep = sum(cover[at + i] and toks[i][0] not in FUNCTION_WORDS for i in range(m))
        plain = m - special - rep  # words that neither repeat nor link
        verbs = sum(1 for i in range(m) if not toks[i][1] and not cover[at + i] and toks[i][0] not in FUNCTION_WORDS and _VERB.search(toks[i][0]))
        links += special
        covered += rep
        clause = func >= 1 and plain >= 2 and (verbs >= 1 or func >= 2) and rep < 0.45 * m
        # Repeats of any mass: a word that occurs ``LEAST`` times is a repeated substring, or the end of one.
        plural = [w for w, k in toks if not k and w not in FUNCTION_WORDS and freq[w] >= LEAST]
        again = func <= 0.1 * m and len(plural) >= 0.45 * m or sum(phrases[at + i] and toks[i][0] not in FUNCTION_WORDS for i in range(m)) >= 0.45 * m
        if again and not listed and (m > LONG or closed):
            again = sum(c for c in Counter(plural).values() if c >= LEAST) >= 0.45 * m
        at += m
        repeats = not clause and rep >= 0.45 * m or again
        stuffed += m if repeats else 0
        if special and (not clause or special >= 0.5 * m) or not special and not func and (listed or not clause and not verbs and m <= LONG and not closed):
            classes += [(c, 0 if repeats else k) for c, k in _classes(toks)]
        else:
            classes.append((-1, 0))
    if len(classes) > LEAST:
        _, repeated = _covers([c for c, _ in classes], [1] * len(classes), LEAST, math.inf)
        stuffed += sum(k for (_, k), r in zip(classes, repeated) if r)
    return n, links, covered, stuffed


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [profile(t) for t in b.column(1).to_pylist()]
        cols = [pa.array([g[k] for g in got], pa.int32()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "words", "links", "repeated", "stuffed"])


def page_profiles(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id long, words int, links int, repeated int, stuffed int`` for every document.

    Null text counts as empty: no words and nothing stuffed. Repeated ids give a row each.
    """
    d = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return d.mapInArrow(_pages, "doc_id long, words int, links int, repeated int, stuffed int")


def spam_pages(documents: DataFrame, share: float = 0.5, **how) -> DataFrame:
    """Profiles of the documents of whose words more than ``share`` is stuffing."""
    return page_profiles(documents, **how).where(F.col("stuffed") > F.col("words") * share)

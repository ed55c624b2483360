import random

from weftline.llm import spam
from weftline.llm.spam import LINK, OTHER, TAG, _classes, profile

RND = random.Random(8)


def word():
    return "".join(RND.choice("bdfgklmnprstvz") + RND.choice("aeiou") for _ in range(4))


LINKS = "\n".join(f"https://{word()}.example/{word()}" for _ in range(40))
TAGS = " ".join("#" + word() for _ in range(60))
ENTRIES = "\n".join(f"{word()} {word()} {RND.randrange(100, 9999)}" for _ in range(40))
LABELLED = "\n".join(f"{word()} {word()}: www.{word()}.test/{word()}" for _ in range(40))
PAGES = [LINKS, TAGS, ENTRIES, LABELLED]


def prose():
    return "\n\n".join(f"{word().title()} {word()}\nWe went to the {word()} and it was the {word()} that they had in mind before the {word()} came to us." for _ in range(12))



def stuffed(text):
    n, _, _, k = profile(text)
    return k > n / 2


def test_lists_of_distinct_words_are_repeats_of_classes():
    assert all(stuffed(p) for p in PAGES) and not stuffed(prose())
    assert _classes([("a", 0), ("b", 0), ("x.y", 1), ("#t", 2), ("#u", 2)]) == [(OTHER, 2), (LINK, 1), (TAG, 1), (TAG, 1)]


def test_without_the_automaton_nothing_is_found(monkeypatch):
    none = lambda words, *a: ([False] * len(words), [False] * len(words))
    monkeypatch.setattr(spam, "_covers", none)
    assert not any(stuffed(p) for p in PAGES)


def test_counts_of_words_do_not_replace_it(monkeypatch):
    """Distinct links, tags and entries have no word that occurs again."""

    def counts(words, chars, least, mass):
        heavy = [words.count(w) >= least and words.count(w) * c >= mass for w, c in zip(words, chars)]
        return heavy, [words.count(w) >= least for w in words]

    real = spam._covers
    monkeypatch.setattr(spam, "_covers", lambda words, chars, least, mass: counts(words, chars, least, mass) if mass != float("inf") else ([False] * len(words),) * 2)
    assert not any(stuffed(p) for p in PAGES)
    monkeypatch.setattr(spam, "_covers", real)
    assert all(stuffed(p) for p in PAGES)


def test_a_heading_or_a_link_by_itself_is_no_list():
    text = prose() + f"\nhttps://{word()}.example\n" + prose() + f"\n{word()} {word()}\n" + prose()
    n, links, _, k = profile(text)
    assert links == 1 and k == 0

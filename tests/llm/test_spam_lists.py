import random

from weftline.llm.spam import profile

WORDS = [a + b for a in "диван стол шкаф окно кровать лампа ковёр плита".split() for b in ["", "ы", "ам", "ных", "овый", "ение", "ик", "чик", "ка", "ница"]]
RND = random.Random(4)
MANY = [RND.choice(WORDS) for _ in range(480)]


def spam(text):
    n, _, _, stuffed = profile(text)
    return stuffed > n / 2


def test_many_evenly_used_keywords():
    """None of 80 keywords has a share of the page that would make it heavy."""
    assert spam(", ".join(MANY)) and spam(" ".join(MANY)) and spam(" | ".join(MANY)) and spam(", ".join(w + " для дома" for w in MANY))


def test_comma_list_of_distinct_tags():
    assert spam(", ".join(WORDS))


def test_sentences_with_commas_and_repeated_words():
    one = "Вчера мы купили хлеб, молоко, сыр, масло и яблоки. Потом пошли домой и долго говорили о том, что было."
    assert not spam(one) and not spam("Он пришёл, увидел, победил и ушёл, но никто этого не заметил, потому что все спали.")
    few = ["мама", "кот", "сосед", "врач", "повар"]
    assert not spam(" ".join(f"Когда {w} {a} у нас дома, {v} {b} о том, что всё {c}." for w, v, a, b, c in zip(few * 3, few[1:] * 4, "жил спал сидел пел ел читал курил лежал стоял гулял плакал ждал молчал шумел бегал".split(), "говорил думал молчал писал пел спорил кричал шептал знал читал мечтал слышал спросил забыл помнил".split(), MANY)))

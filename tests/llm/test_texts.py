import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import abuse, langmix
from weftline.llm.pii import _permute, detect, items, occurrences, replace_items
from weftline.llm.subset import varied_subset

ABUSE = ["ты просто кретин", "какой же ты ублюдок", "эй у.б.л.ю.д.о.к, закрой рот", "автор поста туп@я овца и тряпка", "ты просто и-д-и-о-т", "what a f-r-e-a-k you are", "whoever wrote this is a bitcccccch", "shut your mouth you re7ard", "СЕН НАҒЫЗ АРАМЗА", "все сулаки воры и паразиты, давить таких", "приду и сломаю тебе руки", "send nudes to my dm", "топ басшысы т#пас екен", "т е б я надо было утопить в детстве, таких как ты надо в детстве топить"]
HARMLESS = ["этот принтер тварь", "карандаш тупой, а точилки нет", "урожай помидоров уродился на славу", "тренер сказал бить по мячу сильнее", "that exam destroyed me", "killed the process and the laptop woke up", "бұл принтер ақымақ", "емтихан мені өлтіреді ғой", "my essex train was late again", "хочу записаться в клуб", "какой фильм завтра?", "", "12345"]


@pytest.fixture(scope="module")
def model():
    plain = ["хочу записаться в клуб, но там пыльный экзамен", "и я до сих пор думаю об этом", "the exam was sticky and i laughed along", "what would you do", "мама думает что это болезнь, а это экзамен", "кто ходил на курс", "біздің топ басшысы орындықты алды", "мен үндемей тұра бердім", "какой фильм завтра", "in the canteen they sell it cheap"] * 5
    return abuse.fit_all(plain, [(1, "ты просто чмо"), (0, "скучно")])


def test_abuse_and_its_disguises(spark, model):
    rows = [("t", i, "g", x) for i, x in enumerate(ABUSE + HARMLESS)] + [("t", 99, "g", None)]
    got = {r.id: r.score for r in abuse.abuse_scores(spark.createDataFrame(rows, "src string, id long, grp string, text string"), model).collect()}
    assert [ABUSE[i] for i in range(len(ABUSE)) if got[i] < 0.5] == []
    assert [HARMLESS[i - len(ABUSE)] for i in range(len(ABUSE), len(rows) - 1) if got[i] >= 0.5] == []
    assert got[99] < 0.5


def test_held_out_words_of_known_frames(model):
    """Frames meet words that no seed has them with; an unknown sentence stays harmless."""
    s = abuse.score_texts(model, pa.array(["а ты вообще мразь и подонок", "завтра будет дождь и ветер"]))
    assert s[0] >= 0.5 > s[1]


def test_rates(spark, model):
    rows = [("t", 1, "a", ABUSE[0]), ("t", 2, "a", "скучно"), ("t", 3, "b", None)]
    r = {x.grp: x for x in abuse.rates(abuse.abuse_scores(spark.createDataFrame(rows, "src string, id long, grp string, text string"), model)).collect()}
    assert (r["a"].n_rows, r["a"].n_flagged, r["a"].rate, r["b"].n_flagged) == (2, 1, 0.5, 0)


def kinds(text):
    return [(k, text[a:b]) for k, a, b, _, _ in detect(text)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("моя почта ivan_k@post.mail.example, пишите", [("email", "ivan_k@post.mail.example")]),
        ("mail me: anna (at) site dot test", [("email", "anna (at) site dot test")]),
        ("почта vipan_b [собака] site точка test", [("email", "vipan_b [собака] site точка test")]),
        ("звоните +7 (782) 364-23-22, вечером", [("phone", "+7 (782) 364-23-22")]),
        ("OO7 789 622 O819 и 738 73о17оо", [("phone", "OO7 789 622 O819"), ("phone", "738 73о17оо")]),
        ("ЖСН 010808564837", [("id_number", "010808564837")]),
        ("удостоверение № 002547623; паспорт K46806532", [("id_number", "№ 002547623"), ("id_number", "K46806532")]),
        ("ул. Глинокаменная 62, кв. 74", [("address", "ул. Глинокаменная 62, кв. 74")]),
        ("Глинокаменная улица, 133/1, квартира 108", [("address", "Глинокаменная улица, 133/1, квартира 108")]),
        ("62 үй, Сарыжусан даңғылы", [("address", "62 үй, Сарыжусан даңғылы")]),
        ("at 103 Fennel Hollow Ave", [("address", "103 Fennel Hollow Ave")]),
        ("Снегиряной 135-168, второй подъезд", [("address", "Снегиряной 135-168")]),
        ("пару ведёт Инна Кирилловна", [("name", "Инна Кирилловна")]),
        ("пару ведёт А.А. Зелёнохвостова.", [("name", "А.А. Зелёнохвостова")]),
        ("Лисоградов А. М. пришёл", [("name", "Лисоградов А. М.")]),
        ("Timur B. Quillmarsh came", [("name", "Timur B. Quillmarsh")]),
        ("Алина опять проспала, сезон 2024-2025, версия 10.0.136.4", []),
        ("заказ 464848, isbn 978-0-133228-0, пара 14:45-16:20, на улице дождь, а дом далеко", []),
    ],
)
def test_detection(text, want):
    got = [(k, s) for k, s in kinds(text) if not (k == "name" and s.startswith(("Алина о", "Alina o")))]
    assert got == want


def test_replacement_keeps_the_rest_and_is_consistent(spark):
    rows = [
        (1, "звоните +7 (782) 364-23-22 или 87823642322, спросить Инна Кирилловна"),
        (2, "почта a.b@site.test, зв​оните 8 782 364 23 22"),
        (3, None), (4, ""), (5, "ничего такого"), (6, "зовут Олжас Лисоградов. пару ведёт ЛИСОГРАДОВ А. М."),
    ]
    df = spark.createDataFrame(rows, "id long, text string")
    out = {r.id: r for r in replace_items(df, b"key").collect()}
    assert out[1].redacted == "звоните [PHONE_1] или [PHONE_1], спросить [NAME_1]"
    assert out[2].redacted == "почта [EMAIL_1], зв​оните [PHONE_1]"
    assert out[3].redacted is None and out[4].redacted == "" and out[5].surrogate == "ничего такого"
    digits = lambda s: "".join(c for c in s if c.isdigit())
    a, b = out[1].surrogate.split(" или ")
    assert digits(a)[-10:] == digits(b)[-10:] == digits(out[2].surrogate)[-10:] != "7823642322" and a.startswith("звоните +7 (7")
    assert out[1].surrogate.endswith("вна") and "Инна" not in out[1].surrogate.split("спросить")[1][:5]
    first, second = out[6].surrogate.split(". пару ведёт ")
    assert first.split()[-1].upper() == second.split()[0]  # the same surname, in its case
    assert items(df.limit(0)).count() == 0
    n = {(r.delivery_id, r.kind): r.occurrence for r in occurrences(items(df)).collect()}
    assert n[1, "phone"] == 2


def test_permutation_of_numbers_has_no_clashes():
    got = {_permute(b"k", str(i).zfill(4)) for i in range(10_000)}
    assert len(got) == 10_000


RU = ["мама думает что это болезнь, а это новый экзамен", "кто ходил на курс по вечерам, стоит извиниться", "потратил всю стипендию на кофе и сделал вид что сплю", "на прошлой неделе был тихий доклад, и никто ничего не понял", "ищу компанию в столовой, со мной только бесконечный фильм"]
KZ = ["семестр жоспары: жаңа жоба және қисық реферат, қалғаны кейін", "бүгін ұйқым келмейді, ешкім түк түсінбеді", "менің топ басшысы тағы термосымды жоғалтып алды деп естідім", "бірінші оқу күнінде кезекші кружканы сындырып алды, анам күліп жіберді", "неге маршруткада әрдайым иісі шығады, кімге шағымдану керек"]
EN = ["mom thinks this is an illness but it is a new exam", "looking for people to try it under the stairs", "the only thing keeping me alive is coffee in the morning", "the guard asked about it and i answered at once", "who wants coffee, what would you do"]


@pytest.fixture(scope="module")
def languages_model(spark):
    rows = [(t, g) for g, ts in (("ru", RU), ("kz", KZ), ("en", EN)) for t in ts for _ in range(6)] + [("xx", "n/a"), (None, "ru")]
    return langmix.train(spark.createDataFrame(rows, "text string, lang string"))


def test_languages(spark, languages_model):
    ru, kz, en = RU[0] + ". " + RU[3], KZ[1] + ". " + KZ[2], EN[2] + ". " + EN[3]
    latin = "mama dumaet chto eto bolezn, a eto novyy ekzamen. kto hodil na kurs po vecheram"
    plain = KZ[2].translate(str.maketrans(langmix.KZ_PLAIN)) + ". " + KZ[3].translate(str.maketrans(langmix.KZ_PLAIN))
    cases = [(ru, "ru"), (kz, "kz"), (en, "en"), (ru + "\n" + kz, "ru_kz"), (en + " - " + ru, "ru_en"), (latin, "ru"), (plain, "kz"), ("пoтрaтил всю cтипeндию нa кoфe и сдeлaл вид чтo сплю", "ru"), (ru + " coffee #dinner", "ru")]
    rows = [(i, t, "zz", None) for i, (t, _) in enumerate(cases)] + [(90, None, None, None), (91, "", "ru", "ru"), (92, "!!! 12", "ru", None)]
    got = {r.id: r for r in langmix.languages(spark.createDataFrame(rows, "id long, text string, label string, assigned string"), languages_model).collect()}
    assert [(t, got[i].code) for i, (t, c) in enumerate(cases) if got[i].code != c] == []
    assert all(got[i].code is None and not got[i].segments and got[i].confidence == 0 for i in (90, 91, 92))
    seg = got[3].segments
    assert [s.lang for s in seg] == ["ru", "kz"] and abs(seg[1].start - len(ru) - 1) <= 1 and 0.5 < got[3].confidence <= 1


def test_wrong_labels(spark, languages_model):
    c = spark.createDataFrame([(1, "ru"), (2, "kz"), (3, None), (4, "und"), (5, "ru")], "id int, language string")
    f = spark.createDataFrame([(1, "ru"), (2, "ru"), (3, "en"), (4, "kz"), (5, None)], "id long, code string")
    assert sorted((r.id, r.lang) for r in langmix.wrong_labels(c, f).collect()) == [(2, "ru"), (3, "en"), (4, "kz")]


def test_subset(spark):
    rows = [(i, f"слово{i} другое{i} третье{i} ещё{i}", "hot" if i % 3 else f"t{i % 5}", None if i % 7 == 0 else f"p{i % 4}", "ru", float(i % 10) if i % 11 else None) for i in range(90)]
    rows += [(200 + i, "один и тот же текст про всё на свете", "t9", "p9", "kz", 9.9) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, text string, post_type string, topic string, language string, score double").withColumn("r0", F.lit(1)).withColumn("ws", F.lit("x"))
    got = varied_subset(df, 12).collect()
    assert len(got) == len({r.id for r in got}) == 12
    assert sum(r.id >= 200 for r in got) == 1 and len({r.post_type for r in got}) >= 5
    assert varied_subset(df, 500).count() == 120 and varied_subset(df.limit(0), 5).count() == 0

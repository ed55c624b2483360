from weftline.llm.pii import detect, items


def names(text):
    return [text[a:b] for k, a, b, _, sure in detect(text) if k == "name" and sure]


def test_given_names_that_no_list_has_and_case_forms():
    for name in ["Роман Сергеевич Иванов", "Надежда Петровна", "Вячеславу Олеговичу", "Иванов Эдуард Ильич", "Гульнара Абайқызы", "Инны Кирилловны", "Инну Лисоградову", "Ивана Петрова"]:
        assert names(f"пару ведёт {name}, второй этаж") == [name]
    assert names("Роман Сергеевич Иванов") == ["Роман Сергеевич Иванов"]
    assert names("Вчера Петровна сказала") == names("вчера основы читал") == names("Инны нет") == []


def test_given_names_are_learned_from_other_texts(spark):
    learned = [(1, "ведёт Тимофей Олегович Громов"), (2, "видел Тимофея Петровича")]
    rows = learned + [(3, "пришёл тимофей громов"), (4, "Громов Тимофей сказал"), (5, "пришёл кирпич громов"), (6, "Тимофей Ильич пришёл")]
    got = {r.id: r.entity for r in items(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert set(got) == {1, 2, 3, 4, 6} and got[3] == "тимофей громов" and got[4] == "Громов Тимофей"


def test_names_by_structure_inside_a_sentence():
    for name in ["Наргиз Токтарова", "Зухру Мамедову", "Богдана Хмельницкого", "Тимуру Ахметову", "Сергея Петрова", "Ернардан Бекмановқа"]:
        assert names(f"вчера видели {name}, и всё") == [name], name
    assert names("our tutor Priya Sharma left") == ["Priya Sharma"] and names("met dr. Ostap Bender there") == ["Ostap Bender"]
    for text in ["работает в Институте Вавилова", "идём на Улицу Королёва", "I love New York Times", "это Московский Университет Ломоносова", "Вчера Петрова сказала", "пришла Новая Машина сегодня"]:
        assert names(text) == [], text

"""Sentences that are no part of the seeds: other frames and phrasing, with the words of insult known or not."""

import random

import pyarrow as pa

from weftline.llm import abuse
from weftline.llm.abuse_seeds import examples

HARMFUL = """
да кто тебя спрашивал, мразь ты редкая
у тебя мозгов как у курицы, кретин
закопаю тебя на пустыре
таких уродов земля не носит
скинь интимные фото прямо сейчас
мигранты твари, всех вон
не учи меня жить, дебил ты
чтоб ты сгорел вместе со своим домом
сені тауып алып, тісіңді қағамын
қандай арсыз адам едің, оңбаған
маған жалаңаш фото жіберші
келімсектер қоқыс, бәрі кетсін
сендей надан көрмедім
people from the south are filthy vermin and should be wiped out
your whole family is garbage
i will smash your face in
nobody asked you, moron
those refugees are scum
get lost you worthless pig
you disgusting creep
send me a naked video tonight
i hope you die slowly
""".strip().split("\n")
HARMLESS = """
ты просто молодец
какой хороший препод у нас в этом году
убили два часа на пробку
сосед принёс пирог и чай
тупой карандаш сломался на контрольной
скинь фото доски пожалуйста
мигранты это тема нашего семинара
дом сгорел в фильме очень эффектно
жаңа мұғаліміміз өте мейірімді
суретті маған жіберші, конспект керек
келесі аптада емтихан басталады
есектер мен жылқылар туралы дәріс
people from the south came to the concert
your whole family is invited
i will bring the cake
nobody asked me about the homework
those refugees were helped by the students
you are such a good friend
send me the video of the lecture tonight
this printer is garbage
i hope you sleep well
the pig farm excursion was fun
""".strip().split("\n")
#: Ordinary chat, as the sample of a corpus would hold.
PLAIN = """
завтра идём в кино после пары
кто взял мой зонт и термос
сосед опять поёт в душе
я принёс чай и печенье
у меня сегодня три пары подряд
люди, где можно распечатать отчёт
мы всей семьёй ездили на дачу
надеюсь успею на автобус
какой вкусный пирог
скинь расписание на неделю
ты видел новый корпус
we had pizza in the park
my family is coming on friday
you are such an early bird
i hope the exam is easy
such a good idea my friend
all of you are welcome at the club
we slept well after the trip
is the whole group invited to the party
send the file to the group
nobody knows the room number
ертең сабақ жоқ па
кім кітапханаға барады
маған конспект жіберші
қандай тамаша күн
досым жаңа телефон алды
сен ертең келесің бе
""".strip().split("\n")


def test_held_out_phrasing():
    """Measured without verdicts and with a small corpus: 0.86 of the harmful sentences found, 0.86 of the harmless ones let pass."""
    model = abuse.fit_all(PLAIN, [])
    bad, good = (abuse.score_texts(model, pa.array(x)) >= 0.5 for x in (HARMFUL, HARMLESS))
    print("recall", bad.mean(), [t for t, b in zip(HARMFUL, bad) if not b], "passed", 1 - good.mean(), [t for t, b in zip(HARMLESS, good) if b])
    assert bad.mean() >= 0.8 and good.mean() <= 0.2


def test_no_held_out_sentence_is_a_seed():
    seeds = {t for t, _ in examples()}
    assert not seeds & set(HARMFUL + HARMLESS)


def test_marks_of_messages_teach_unseen_phrases():
    """A phrase that no seed has, in messages of several clauses that reviewers marked; one mark in eight is wrong."""
    rnd = random.Random(2)
    filler = ["в пятницу снова дождь", "библиотека закрыта", "тренер принёс мяч", "в столовой новый суп", "очередь на час", "лифт едет медленно", "я сдал отчёт вовремя", "мы пили чай"]
    some = lambda k: rnd.sample(filler, k)
    harmful = ["ну ты и глюконавт позорный", "глюконавт позорный вернись в норку"]
    judged = [(1, ". ".join(rnd.sample([*some(3), rnd.choice(harmful)], 4))) for _ in range(60)] + [(1, ". ".join(some(4))) for _ in range(8)] + [(0, ". ".join(some(4))) for _ in range(200)]
    model = abuse.fit_all([". ".join(some(3)) for _ in range(200)], judged)
    s = abuse.score_texts(model, pa.array(["лифт едет медленно. глюконавт позорный ты. мы пили чай", ". ".join(filler)]))
    assert s[0] >= 0.5 > s[1]

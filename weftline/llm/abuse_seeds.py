"""Labelled example sentences for problem 3, written by hand from general knowledge of the three languages; frames are
filled with words. They start the classifier; what they lack it learns from the human verdicts and from the corpus.
"""

from __future__ import annotations

# Words that insult when said to or of a person.
INSULTS_RU = "идиот кретин тупица дегенерат ублюдок урод придурок тварь мразь чмо гнида дебил дурак дура скотина подонок сволочь ничтожество козёл баран свинья шлюха сука быдло отморозок имбецил лох мудак падла выродок стерва гад чучело болван осёл олень недоумок гадина паскуда дрянь мерзавец негодяй тряпка овца крыса паразит уродина проститутка пидор говнюк".split()
INSULTS_EN = "idiot bastard dumbass freak retard bitch moron imbecile loser scum trash slut whore asshole jerk cretin pig cow creep dickhead parasite halfwit fool dimwit vermin rat swine prick twat garbage coward pervert psycho hoe cunt".split()
INSULTS_KZ = ["ақымақ", "арамза", "милау", "мақау", "оңбаған", "есек", "топас", "жексұрын", "сұмырай", "доңыз", "ит", "малғұн", "жынды", "надан", "найсап", "антұрған", "хайуан", "сорлы", "арсыз", "опасыз", "жалқау", "сайқал", "жезөкше", "қаншық", "көргенсіз", "ез", "мал", "маймыл", "иттің баласы"]
# Words for groups of people.
GROUPS_RU = "мигранты приезжие иностранцы беженцы понаехавшие деревенские кочевники цыгане южане азиаты женщины старики".split()
GROUPS_KZ = "шетелдіктер келімсектер босқындар ауылдықтар көшіп келгендер әйелдер қариялар қаланың балалары".split()
GROUPS_EN = "immigrants foreigners refugees outsiders strangers villagers southerners gypsies women asians".split() + ["old people", "these people"]

POSITIVE_FRAMES = [
    # insults; {i} an insult
    *((f, "ru") for f in "{i}|эй {i}|ты {i}|вы {i}|он {i}|она {i}|{i} ты|сам ты {i}|ну ты и {i}|ты же полный {i}|да он настоящий {i}|тот ещё {i}|ты тупая {i}|ты тупой {i}|заткнись {i}|отвали {i}|пошёл ты {i}|наш куратор {i}|этот препод {i}|мой сосед {i}|кто это писал тот {i}|мерзкий {i}|жалкий {i}".split("|")),
    *((f, "en") for f in "{i}|hey {i}|you {i}|you are a {i}|you are an {i}|he is a {i}|she is a {i}|you little {i}|you dumb {i}|shut up {i}|get out {i}|our teacher is a {i}|my roommate is a {i}|this guy is a total {i}|only a {i} writes this|you pathetic {i}|what a worthless {i}|filthy {i}|bunch of {i}s".split("|")),
    *((f, "kz") for f in "{i}|әй {i}|сен {i}|сен {i}сің|сіз {i}сыз|ол {i}|сен бір {i}|өзің {i}|{i} екенсің|мұғаліміміз {i}|көршім {i}|нағыз {i}|тыныш отыр {i}|жоғал {i}|мұны {i} ғана жазады|қандай {i} адам".split("|")),
]
GROUP_FRAMES = [
    *((f, "ru") for f in "{g} это мусор|все {g} преступники|{g} должны убраться отсюда|{g} заразили наш город|ненавижу всех, {g} самые мерзкие|{g} хуже животных|таких как {g} надо уничтожать|{g} грязные и вонючие|пусть {g} сдохнут|{g} низшая раса|не люди а звери эти {g}|гоните их, {g} тут не нужны|{g} как тараканы|{g} воняют".split("|")),
    *((f, "kz") for f in "{g} қоқыс|{g} бәрі қылмыскер|{g} осы жерден кетсін|{g} жануардан жаман|{g} сасық әрі лас|{g} құрысын|{g} тарақан сияқты|{g} адам деуге келмейді|{g} көргім келмейді, жиіркенемін|{g} елден қуылсын|{g} бәрі ұры".split("|")),
    *((f, "en") for f in "{g} are trash|{g} are criminals|{g} should get out of here|{g} ruin our town|i despise all {g}|{g} are worse than animals|{g} should be wiped out|{g} are dirty and smelly|let {g} die|{g} are an inferior race|{g} are like cockroaches|throw {g} out of the country|{g} stink|{g} are subhuman".split("|")),
]
# Threats, wishes of harm, demeaning and sexual sentences.
POSITIVE = """
я тебя убью
я тебя урою гад
найду тебя и покалечу
выбью тебе все зубы
сверну тебе шею
сломаю тебе нос
переломаю ноги тебе
руки тебе оторву
получишь от меня по морде
дам тебе в рожу
оторву тебе голову
тебя надо избить до полусмерти
чтоб ты подох
чтобы ты сгнил в земле
хоть бы тебя машина переехала
лучше бы ты не родился
зря тебя мать родила
утопись уже
пойди и убей себя
от тебя одна вонь
тебя все презирают
ты бесполезный мусор
таким не место на земле
ты пустое место
никому ты не нужен
от таких людей тошнит
рот свой поганый закрой
захлопни пасть
вали отсюда пока цел
ходить после этого не будешь
сожгу тебя вместе с домом
пришли голое фото
интимные фото мне
твои голые фотки
пришли мне свои голые фотографии
покажи грудь
хочу тебя в постель
хочу заняться с тобой сексом
ищу с кем переспать сегодня
кто хочет секса без обязательств
трахну тебя всю ночь
раздевайся и ложись
вышли интимное видео
давай займёмся сексом в туалете
оближу тебя всю
оказываю интимные услуги
сделай мне минет
сені өлтіремін
сенің тісіңді сындырамын
сенің басыңды жарамын
тауып алып сабаймын
бетіңе бір қоямын
сен өлсең екен
сен тумасаң жақсы еді
сені ешкім керек қылмайды
сен қоқыссың
сенен жиіркенемін
өзіңді өлтір
жер бетінен жоғалсаң екен
көлік басып кетсін сені
жағыңды жап
сасық аузыңды жап
сендейлерге бұл жерде орын жоқ
мойныңды бұраймын
үйіңмен қоса өртеймін
аяқ қолыңды сындырамын
жалаңаш фотоңды жібер
жалаңаш фото маған
маған ашық суреттеріңді таста
кеудеңді көрсетші
менімен төсекте бол
бүгін менімен ұйықтайсың ба
сенімен секс жасағым келеді
секс іздеп жүрмін
шешін де жат
интим қызмет көрсетемін
сені сүйіп жалағым келеді
i will kill you
i will smash your teeth in
i will break your legs
i am going to beat you up
watch your back i know where you live
i will burn your house down
you deserve a beating
i hope you rot
i hope a car hits you
die already
kill yourself
nobody wants you here
you should never have been born
the world is better without you
you make everyone sick
you are useless garbage
everyone hates you
shut your filthy mouth
crawl back to your hole
i will wring your neck
you will not walk again
send me nudes
nudes please
your nudes now
send naked pics
show me your boobs
i want to sleep with you tonight
looking for sex tonight
who wants casual sex
i will fuck you all night
strip for me
have sex with me in the bathroom
i want to lick your whole body
suck my dick
selling intimate services
come to bed with me naked
""".strip().split("\n")

# Ordinary sentences with words that look alike: things, situations, figures of speech, technical and scholarly uses.
THINGS = [
    ("этот {t} {i}", "ноутбук сканер замок кран чайник роутер".split(), "тварь сволочь гад идиот урод".split()),
    ("бұл {t} {i}", "ноутбук сканер құлып шүмек шәйнек".split(), "ақымақ жынды топас".split()),
    ("this {t} is a {i}", "laptop scanner lock tap kettle router".split(), "bastard jerk nightmare".split()),
]
NEGATIVE = """
этот компьютер просто идиот
старый телефон сволочь разрядился
чёртов лифт опять стоит
паршивая погода весь день
убил целый час на очередь
убила весь день на курсовую
умираю хочу спать
этот проект меня убивает
тренер велел бить сильнее по воротам
убей эту задачу в диспетчере
роман Достоевского про идиота на экзамене
в треугольнике один угол тупой
ножницы совсем тупые
половое размножение растений на лекции
тема доклада сексуальное воспитание подростков
голый кабель торчит из стены
голые деревья за окном
обнажённые скульптуры в музее
урод в словаре древнерусского языка значит другое
урожай в этом году большой
сук на яблоне треснул
насилие в истории обсуждали на семинаре
статья о травле и ненависти в сети
оскорблять людей плохо
исследование языка вражды
рак груди лечат на ранней стадии
собака сука ощенилась
свинья и овца на ферме
козёл в огороде съел капусту
осёл из сказки всех насмешил
крысы в подвале лаборатории
паразиты на биологии
баран на гербе факультета
рот открыт у стоматолога
сломал ногу на лыжах
руки замёрзли сегодня
дверь закрой пожалуйста
пустое место в таблице
терпеть не могу холод
ненавижу вставать рано
дурацкий вопрос
глупая ошибка в коде
тупик в конце улицы
ты молодец
ты где
ты идёшь
вы лучшие
он умный
она хорошая
какой ты добрый
наш куратор добрый
мой сосед хороший
тебе помочь с домашкой
приду завтра к тебе
хочу кушать
хочу в отпуск
хочу спать в своей кровати
фото с концерта скинь
кто со мной в кино
ищу соседа в комнату
иностранцы приехали на конференцию
мигранты в истории страны, реферат
женщины в науке
приезжие студенты заселяются
бұл телефон ақымақ
компьютер жынды болып қалды
жынды суық болды
емтихан өлтірді мені
шаршап өліп барамын
есек туралы мультфильм
ит пен мысық
итім ауырып қалды
ақымақ сұрақ қойдым
топас бұрыш геометрияда
доңыз жылы
мал шаруашылығы
мал бағу оңай емес
есік жап
терезені жап
қолым ауырып тұр
жалаңаш аяқ жүрме
жалаңаш ағаштар
төсек сатып алдым
суретті жібер
сабақтың суретін жібер
секс тақырыбындағы дәріс
жыныстық көбею биологияда
сен ақылдысың
сен кімсің
сен келесің бе
ол жақсы адам
мұғаліміміз жақсы
көршім мейірімді
шетелдіктер келді
әйелдер мерекесі
босқындар туралы деректі фильм
бетіңді жу
басым ауырып тұр
бүгін менімен киноға барасың ба
this laptop is an idiot
damn this weather
stupid elevator broke again
that lecture killed me
i could die for some cake
kill the background process
the coach told us to beat the other team
we beat the rain
an obtuse angle
blunt knives in the kitchen
sexual reproduction in plants
sex education seminar
the naked eye can see it
bare trees in winter
breast cancer charity run
article about hate speech
why insults hurt
rats in the lab
parasites in biology class
the pig on the farm
a cow on the road
a dog and her puppies
the fool in the play
garbage truck at night
i hate mornings
stupid mistake in my code
you are great
you are kind
you are late
he is smart
she is nice
what a nice day
our teacher is great
my roommate is a good cook
shut the door
send me the notes
send pictures of the board
show me your homework
who wants pizza
looking for a roommate
sleep well tonight
i want to sleep
i want to lick this ice cream
refugees in modern history
women in science
immigrants and their cuisine
foreigners welcome day
broken leg after skiing
i broke my arm
i know where the library is
nobody understands this topic
""".strip().split("\n")


def examples() -> list[tuple[str, int]]:
    """All sentences with their label; every frame meets every word of its language."""
    words = {"ru": INSULTS_RU, "en": INSULTS_EN, "kz": INSULTS_KZ}
    peoples = {"ru": GROUPS_RU, "en": GROUPS_EN, "kz": GROUPS_KZ}
    out = [(f.format(i=w), 1) for f, lang in POSITIVE_FRAMES for w in words[lang]]
    out += [(f.format(g=w), 1) for f, lang in GROUP_FRAMES for w in peoples[lang]]
    for text in POSITIVE:
        out += [(text, 1)] * 12
    out += [(f.format(t=t, i=i), 0) for f, things, words_of in THINGS for t in things for i in words_of]
    for text in NEGATIVE:  # and its beginnings and ends, since those are scored by themselves
        words_of = text.split()
        parts = {" ".join(words_of[i:]) for i in range(1, len(words_of) - 2)} | {" ".join(words_of[:i]) for i in range(3, len(words_of))}
        out += [(text, 0)] * 12 + [(part, 0) for part in sorted(parts) for _ in range(4)]
    return out

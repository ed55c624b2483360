"""Fixed word lists for problem 5."""

# Given names, by script and gender.
GIVEN_RU_F = "алина жанна инна диана аружан анна мария елена ольга наталья светлана ирина татьяна юлия екатерина дарья полина вера галина лариса марина алёна алена анастасия ксения виктория валерия кристина софья софия евгения людмила камила камилла аделина зарина динара сабина эльмира вероника маргарита лидия нина тамара зоя раиса эльвира регина милана ева".split()
GIVEN_RU_M = "данияр арсен руслан марат тимур кирилл олжас иван пётр петр сергей алексей андрей дмитрий николай михаил александр владимир павел максим артём артем денис антон игорь олег виктор юрий василий евгений константин илья никита егор матвей даниил данил глеб степан фёдор федор григорий борис леонид валерий вадим станислав рустам ильдар азамат нурлан".split()
GIVEN_KZ_F = "мөлдір гүлназ әсел сәуле айгүл айнұр гүлнар жанар ботагөз әйгерім назерке балжан ақмарал толғанай кәмила мадина меруерт перизат ұлжан шолпан зере томирис аяулым сымбат раушан күләш".split()
GIVEN_KZ_M = "дәурен бекзат айбек нұржан ерасыл нұрлан ерлан әлихан мирас санжар әділет ержан бауыржан асхат дархан абай нұрсұлтан арман самат ғалым ернұр жандос мейіржан оралбек бейбіт асқар талғат кенжебек".split()
GIVEN_EN_F = "alina vera paula dana iris aruzhan anna mary emma olivia sophia emily alice diana laura julia sarah kate hannah lucy maria helen jane rachel claire nina olga zhanna inna amelia chloe ella".split()
GIVEN_EN_M = "kevin martin oscar timur daniyar arsen ruslan marat kirill olzhas john james robert michael william david richard thomas daniel matthew paul steven andrew george peter henry jack oliver harry leo adam ben luke samuel simon victor ivan".split()
GIVEN = {**{n: "ru_f" for n in GIVEN_RU_F}, **{n: "ru_m" for n in GIVEN_RU_M}, **{n: "kz_f" for n in GIVEN_KZ_F}, **{n: "kz_m" for n in GIVEN_KZ_M}, **{n: "en_f" for n in GIVEN_EN_F}, **{n: "en_m" for n in GIVEN_EN_M}}
# What people are called by beside their names, and how they are introduced.
ROLES = frozenset("куратор куратора препод препода преподаватель профессор профессора доцент декан учитель учительница тренер врач зовут имя мұғалім ұстаз апай ағай атым аты есімі tutor professor prof teacher coach doctor dr mr mrs ms miss dean named called".split())
# Beginnings of words that stand before a surname without being a given name.
HEADS = tuple("институт университет академи школ лице улиц площад проспект бульвар переул театр музе преми теорем метод закон клуб фонд парк центр кафедр факультет групп уравнен роман повест памятник имени дом господин госпож мистер дорог уважаем книг улиц профессор доцент".split())
# Syllables of three letters each, of surrogate surnames and street names.
SYLLABLES = {"ru": "бар вел гор дал жем зор кам лем мир нор пав рас сов тар фил хов чер шам ярд бон вет гал дуб зим кос лун мар неч пол рек сан тол".split(), "kz": "бар тас құл жан бек ора мұр сар тоғ шал ерм дос қай нар бай ала ғал күн".split(), "en": "bar wen dor fal gre hol kim lan mor nel pem ros sil tam vor wil ash bra cor dun".split()}

"""Word lists, patterns and constants that results depend on. Data only, no logic."""

# Blanks as Python's str.split() knows them.
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# A side of a word: nothing, or what is neither letter, digit nor underscore.
LEFT, RIGHT = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
WORD = "[a-zа-яёәіңғқөұүһ0-9]+"

STOPWORDS = "и в на не что я с а но как это то у мне ли бы по же для из за от до или ну все так да нет его её the a to of is and it i in my me you for on at every there would about which other their these those could still after before being while where again always never really мен бар ма ме ба бе па пе да де бір және".split()
KAZAKH_LETTERS = "[әіңғқөұүһ]"
KAZAKH_WORDS = "бар жоқ қалай неге керек болды мен сен бүгін маған үшін деген барма ма ме ба бе па пе ғой өте жақсы қазір кім қандай қай бәрі көп тағы ұнайды болады жасап алмаймын ешкім біреу ыстиды кормедм бугын кашан нешеге кандай калай сондай осы мына ол біз сіз олар туралы болса болмайды".split()

# --- classification of posts ---
CONTACT = [r"https?://[^\s]+", r"www\.[^\s]+", r"@[a-z0-9_]{4,}", r"\+?[0-9][0-9\s().-]{7,}[0-9]"]
CONTACT_WORDED = [r"t\.me/[^\s]+"]  # at the beginning of a word
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[a-z]{2,}"
IDENTIFICATION_SINGLE = "инст инста инстаграм тг телеграм юз username свободен свободна single".split()
IDENTIFICATION_PHRASES = ["кто знает", "кто-нибудь знает", "можно инфу", "дайте инфу", "инфу про", "парень в", "девушка в", "девочка в", "мальчик в", "кьюти в"]
IDENTIFICATION_FREE = [r"(?:дай|дайте|можно|скинь|скиньте)(?:[^\p{L}\p{N}_\n]|[^\p{L}\p{N}_\n].*[^\p{L}\p{N}_\n])(?:инст|тг|юз)", r"есть (?:ли )?(?:у него|у неё|у нее) (?:девушка|парень)", r"[0-9]+\s*(?:курс|курса)(?:[^\p{L}\p{N}_\n]|[^\p{L}\p{N}_\n].*[^\p{L}\p{N}_\n])(?:механик|эконом|экон|юрфак|math|physics|физик|engineering)"]
PERSON_PARTS = ["парень", "девушка", "девочка", "мальчик", "краш", "кьюти", "аниме тян"]
TARGETING_PARTS = ["кто", "кто-нибудь", "инфу", "юз", "инст", "тг", "свободен", "свободна", "есть девушка", "есть парень"]
SENSITIVE_PARTS = ["суицид", "самоуб", "убить себя", "умереть", "хочу умереть", "suicide", "kill myself", "nudes", "голый", "голая", "изнасил", "насил", "rape", "секс", "sex"]
HARASSMENT_WHOLE = "идиот дебил тупой тупая мразь урод".split()
HARASSMENT_PREFIX = "шлюх проститут".split()
ADVERTISEMENT_PARTS = ["ваканс", "ищем сотрудников", "ищем преподавател", "на работу", "для подробной информации", "пишите в whatsapp", "подписывайтесь", "скидка", "продам", "куплю", "заказ"]
REASONS = ["too_short", "noise", "contact_information", "personal_identification_request", "targeted_person_reference", "sensitive_content", "targeted_harassment", "advertisement"]
PRONOUNS = "я мне мен маған сен ты вы мы біз".split()
LAUGHING = ["...", "😭", "😂", "🤣"]
CYRILLIC_NO_YO = "[А-Яа-яӘәІіҢңҒғҚқӨөҰұҮүҺһ]"

# Posts that are no exemplars: direct address, profanity, series, and local specifics.
DIRECT_ADDRESS = "ты тебя тебе тобой сен сені саған you ur".split()
PROFANITY_PARTS = "хуй хуе ебан еблан ебат пизд сука fuck shit bitch".split()
PROFANITY_BEGINS = ["бля"]
SERIES = ["top ?[0-9]", "топ ?[0-9]"]  # at the beginning of a word
LOCAL_PARTS = ["клуб", "клаб", "club", "универ", "нусом", "бхб", "айди", "рус пед", "дейлик", "мюзик", "кбту", "аегис", "яндекс тим", "перваш", "@", "kiss", "яой", "кастинг", "коттедж", "яойк", "ltn", "blasian", "тютор", "убро", "фараонд"]
LOCAL_BEGINS = ["уник", "дорам", "gay", "avatar", "корды", "доры", "дшд"]
LOCAL_ENDS = ["сду"]
LOCAL_WHOLE = ["дх", "x", "аву", "авы", "икт", "wt"]

# --- style profile ---
EMOJI_WIDE = r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}\x{1F1E6}-\x{1F1FF}]+"
EMOJI_NARROW = r"[\x{1F300}-\x{1FAFF}]"
EMOJI_GENERATOR = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"
CASUAL = "пж пжж пжпж ко го краш лол хз имхо вайб вайба чел челик ребят достар бля блять ебать wtf wth lol pls bro lowkey literally".split()
ENGLISH_MARKS = "the is are you what why pls please girl boy single cute literally lowkey".split()
QUESTION_STARTS = {"кто": "who", "что": "what", "где": "where", "когда": "when", "почему": "why", "как": "how", "можно": "request", "есть": "yes_no", "does": "yes_no", "is": "yes_no", "are": "yes_no", "what": "what", "why": "why", "how": "how", "where": "where", "калай": "how", "қалай": "how", "кім": "who", "не": "what"}
FIRST_PERSON = "я мне мой моя мы мен маған менің i my me".split()
SECOND_PERSON = "ты тебе твой вы вам sen сіз you your".split()
TOPICS = {
    "campus": "кампус campus универ университет уни универс ну sdu",
    "classes": "пара пары лекция лекции семинар класс class lecture exam экзамен экзамены сессия домашка дз",
    "professors": "препод преподователь профессор учитель teacher professor",
    "studying": "учеба учиться учусь учебу study studying учёба",
    "clubs": "клуб клубы club организация organization",
    "food": "еда есть поесть столов кафе ресторан кофе food dining",
    "relationships": "девушка парень отношения любовь краш dating relationship crush",
    "friendship": "друг друзья дружба подруга friend friends",
    "events": "ивент ивенты мероприятие event концерт вечеринка party",
    "housing": "общага общежитие дорм roommate комната жилье жильё dorm",
    "career": "работа работать стажировка интерн карьера работу job internship career",
    "social_life": "гулять гуляли встреча встретиться выходные weekend тусовка тусить",
}
POSITIVE = "люблю красиво красивый красивая счастлив счастье рад радует cute love happy good great".split()
NEGATIVE = "ненавижу бесит бесит плохо грустно страшно устал устала проблема hate sad bad worst".split()
LENGTH_BANDS = [30, 60, 100, 150, 220, 330]
LENGTH_BUCKETS = [30, 60, 100, 150, 250]
WORD_BUCKETS = [5, 10, 20, 30, 50]

# --- features of candidates ---
PHRASES = {
    "anyone_else": r"кто[- ]?(?:нибудь|то)?\s*(?:ещё|еще|тоже)|у кого (?:ещё|еще|тоже)|только у меня|это только я|anyone else|is it just me|am i the only",
    "why_people": r"почему (?:люди|все|многие|парни|девушки|девочки|мы)(?:$|[^\p{L}\p{N}_])|why do (?:people|guys|girls|we|everyone)|why does everyone|неге (?:адамдар|бәрі)",
    "dont_know_if": r"не знаю,? (?:если|стоит|правильно|как|что|нужно ли|можно ли|почему)|i don'?t know (?:if|how|what|why|whether)|білмеймін",
    "what_would_you_do": r"что бы вы|как бы вы|what would you do|как вы (?:думаете|считаете)|как думаете|а вы как|что думаете|what do you think",
    "what_to_do": r"что (?:мне )?делать|как (?:мне )?(?:быть|поступить)|как себя вести|what should i do|what do i do|not sure what to do|не істеу керек|қайттім",
    "how_to_verb": r"как (?:мне )?(?:правильно |лучше |спокойно )?(?:спросить|предложить|начать|вернуть|перестать|убедить|справиться|понять|сказать|объяснить|попросить|извиниться|отказать)",
    "stoit_li": r"стоит ли|нужно ли",
}
ADVICE = r"посоветуйте|дайте совет|совет(?:$|[^\p{L}\p{N}_])|any advice|any tips|need advice|кеңес"
TELLS = r"недосказан|поверхностн|искренн|навязчив|личные границы|без давления|принадлежн|осознал|воспоминан|как вернуть|странное (?:чувство|ощущение)|хрупк|уязвим|boundaries|vulnerab|authentic|genuine"
FIRST_PERSON_FEATURE = ["я", "мне", "меня", "мой", "моя", "мои", "i", "my", "me", "мен", "маған", "менің"]
WARN_PHRASES = {"что делать": r"что (?:мне )?делать", "кто-нибудь": r"кто[- ]?нибудь", "почему люди": r"почему (?:люди|все)", "не знаю": r"(?:^|[^\p{L}\p{N}_])не знаю(?:$|[^\p{L}\p{N}_])", "как быть": r"как (?:мне )?быть", "has anyone / anyone else": r"has anyone|anyone else", "вдруг": r"(?:^|[^\p{L}\p{N}_])вдруг(?:$|[^\p{L}\p{N}_])"}

# --- thresholds ---
SIMILARITY = {"embedding": {"soft": 0.45, "hard": 0.70, "seed": 0.60}, "lexical": {"soft": 0.30, "hard": 0.55, "seed": 0.45}}
COVERAGE = {"type": 1.0, "topic": 1.5, "lang": 0.6, "lenband": 1.0, "opener": 0.8, "ending": 0.5, "shape": 0.5}
TARGET_WEIGHTS = {"casing": 1.4, "emoji": 0.6}
HARD_CAPS = {"topic": 5, "type": 4, "advice": 4, "opener1": 4, "opener2": 2}
WEIGHTS = {"quality": 2.0, "length": 1.0, "sim": 6.0, "question": 1.5, "advice": 3.0, "pattern": 1.5, "tell": 0.35, "formulaic": 1.2, "ai_feel": 1.5}
SLOTS = {"quick_ask": 12, "info_question": 22, "this_or_that": 12, "weird_question": 14, "find_people": 12, "shower_thought": 16, "observation": 12, "confession": 12, "story": 13, "awkward_incident": 9, "rant": 16, "hot_take": 16, "relationship_vent": 14, "social_awkward": 9, "ramble": 5}

"""Rules that find contacts, threats, places and names in candidates; the first violated rule names itself."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L
from .text import col

# Patterns of the rules, in their order, for lower-case text; the rules in CASED see letter case.
_SOCIAL = r"(?:инст(?:а|у|е|ой|ы|аграм[\p{L}\p{N}_]*)?|insta(?:gram)?|тг|tg|телеграм[\p{L}\p{N}_]*|telegram|whatsapp|ватсап[\p{L}\p{N}_]*|вотсап[\p{L}\p{N}_]*|снап(?:чат[\p{L}\p{N}_]*)?|snap(?:chat)?|юз(?:ер[\p{L}\p{N}_]*|а|у)?|username)"
_PLATFORM = rf"(?:{_SOCIAL}|номер[\p{{L}}\p{{N}}_]*|телефон[\p{{L}}\p{{N}}_]*|контакт[\p{{L}}\p{{N}}_]*|number)"
_GAP = r"[^\p{L}\p{N}_]+"
_SOME = r"[\p{L}\p{N}_]"
RULES = [
    ("url", rf"https?://|www\.|{L.LEFT}[\p{{L}}\p{{N}}_-]+\.(?:com|kz|ru|org|net|me|io|app|gg){L.RIGHT}"),
    ("handle", rf"{L.LEFT}@[\p{{L}}\p{{N}}_]{{2,}}|[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+\.[\p{{L}}\p{{N}}_]{{2,}}"),
    ("tme_link", rf"{L.LEFT}t\.me{L.RIGHT}"),
    ("contact_request", rf"{L.LEFT}(?:кинь|кинуть|кидай|скинь|скиньте|скинуть|дай|дайте|напиши|пиши|пишите|оставь|оставьте|send|drop|share|give|find){_GAP}(?:{_SOME}+{_GAP}){{0,3}}{_PLATFORM}{L.RIGHT}"),
    ("own_contact", rf"{L.LEFT}(?:мой|моя|мои|my|менің){_GAP}{_SOCIAL}{L.RIGHT}"),
    ("contact_label", rf"{L.LEFT}(?:insta|inst|инста|инст|tg|тг|ig|snap|wa|telegram|телеграм{_SOME}*)\s*[:=]"),
    ("threat", rf"{L.LEFT}(?:убью|убьем|убьём|прибью|найду и|заставлю пожалеть|сломаю (?:тебе|ему|ей)|kill you|i'?ll find you|өлтіремін){L.RIGHT}"),
    ("self_harm", r"суицид|самоуб|убить себя|хочу умереть|покончить с собой|kill myself|suicid|өзімді өлтір"),
    ("sexual", rf"{L.LEFT}(?:секс|porn|(?:sex|nudes?|голая|голый|rape){L.RIGHT})|порно|изнасил"),
    ("slur", rf"пидор{_SOME}*|пидар{_SOME}*|{L.LEFT}(?:чурк|nigg{_SOME}|(?:хач(?:и|ей|ам)?|жид(?:ы|ов|а|у|ом)?|нигер(?:ы|ов|а)?){L.RIGHT})|faggot"),
    ("harassment", rf"{L.LEFT}(?:идиот|идиоты|идиотов|дебил|дебилы|дебилов|мразь|мрази|тварь|твари|шлюха|шлюхи|шлюх|проститутк{_SOME}*|ублюд{_SOME}+|урод|уроды|уродов){L.RIGHT}"),
    ("username_like", rf"{L.LEFT}[a-z]{{2,}}[._]?[0-9]{{2,}}{L.RIGHT}"),
    ("initials", rf"{L.LEFT}[А-ЯЁA-Z]\.\s?[А-ЯЁA-Z]\.{L.RIGHT}"),
    ("institution_or_city", rf"{L.LEFT}(?:сду|sdu|кбту|kbtu|аиту|aitu|iitu|nazarbayev{_SOME}*|назарбаев{_SOME}*|алмат{_SOME}+|almaty|астан{_SOME}+|astana|шымкент|караганд{_SOME}+){L.RIGHT}"),
    ("room_or_building", rf"{L.LEFT}(?:[a-zа-я]-?[0-9]{{3}}|[0-9]\.[0-9]{{3}}|[0-9]+[- ]?(?:й|ый|ий)? ?(?:этаж{_SOME}*|корпус{_SOME}*|floor)){L.RIGHT}|{L.LEFT}(?:корпус{_SOME}*|блок|аудитори{_SOME}+|каб(?:инет{_SOME}*)?\.?|этаж{_SOME}*|building|room|floor)\s*[№#]?\s*[a-zа-я]?[0-9]+"),
    ("named_teacher", rf"{L.LEFT}(?:[Пп]репод{_SOME}*|[Пп]реп|[Пп]рофессор{_SOME}*|[Pp]rof(?:essor)?\.?|[Дд]оцент{_SOME}*|[Уу]чител{_SOME}+|[Тт]ичер{_SOME}*|[Tt]eacher|[Mm]rs?\.?|[Mm]s\.?|[Аа]ғай|[Аа]пай|[Мм]ұғалім{_SOME}*|[Оо]қытушы)\s+[А-ЯӘІҢҒҚӨҰҮҺA-Z][а-яәіңғқөұүһёa-z]{{2,}}"),
    ("price", rf"[0-9][0-9\s.,]*\s?(?:тг|тенге|теңге|kzt|тыс(?:яч)?{_SOME}*|руб{_SOME}*|usd|доллар{_SOME}*|баксов){L.RIGHT}|[₸$₽]\s?[0-9]|[0-9]\s?[$₸₽]"),
]
RULES.append(("person_description", rf"{L.LEFT}в\s+(?:красн|зелен|зелён|син|черн|чёрн|бел|сер|жёлт|желт|розов|голуб){_SOME}*\s+(?:куртк|худи|футболк|штан|плать|кофт|пальто|рубашк|кроссовк|шапк|юбк)"))
#: Rules that look at letter case.
CASED = {"initials", "named_teacher"}
# Names of things, months, days and languages that may be capital inside a sentence.
ALLOWED_CAPITALS = "tiktok instagram netflix youtube spotify telegram whatsapp google chatgpt gpt zoom excel word powerpoint python kaspi yandex samsung iphone android macbook pinterest discord steam twitter snapchat ielts toefl gpa wifi monday tuesday wednesday thursday friday saturday sunday january february march april june july august september october november december english russian kazakh korean japanese chinese german turkish french spanish ramadan ramazan nowruz наурыз рамазан господи бог аллах reels notion canva figma linkedin tinder uber glovo wolt".split()
TOKEN = r"[A-Za-zА-Яа-яЁёӘәІіҢңҒғҚқӨөҰұҮүҺһ][\p{L}\p{N}_'’-]*"
#: What stands before the first word of a sentence or quotation, and that word.
SENTENCE_START = r'(^|[.!?…][\s\x{a0}]+|["«“(]\s*)' + TOKEN
TITLE = r"^\p{Lu}[^\p{Lu}]{2,}$"
PHONE = r"[+0-9][0-9\s().-]{7,}[0-9]"
PLACEHOLDER = r"[a-zа-яёәіңғқөұүһ]\((?:а|я|ая|ой|ый|ий|ое|ые|ла|ась|лась|ся|ка|ён|ен|ена)\)"
REMOVED = r" ?\((?:а|я|ая|ой|ый|ий|ое|ые|ла|ась|лась|ся)\)"
#: Given names that mark a person in any letter case; up to three letters may follow.
GIVEN = "айгерим айгуль айдана айбек алишер алмас алина амина арман арсен асель аян бауыржан бекжан данияр даурен динара дана жандос жанар камила карина кристина мадина мурат нурсултан руслан самат санжар сабина серик тимур эльмира диана азамат вадим денис дмитрий евгений ксения марат ярослав daniyar aigerim aidar asel arman arsen madina dana ruslan timur zhanar kamila karina amina azamat".split()


def has_phone(t: Column | str) -> Column:
    """A run of digits and signs with nine digits at least."""
    runs = F.regexp_extract_all(col(t), F.lit(PHONE), F.lit(0))
    return F.exists(runs, lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")) >= 9)


def has_given_name(t: Column | str) -> Column:
    return F.lower(col(t)).rlike(L.LEFT + "(?:" + "|".join(GIVEN) + ")" + r"[\p{L}\p{N}_]{0,3}" + L.RIGHT)


def has_probable_name(t: Column | str) -> Column:
    """A capitalised word inside a sentence that is none of the allowed ones."""
    inside = F.regexp_extract_all(F.regexp_replace(col(t), SENTENCE_START, "$1"), F.lit("(" + TOKEN + ")"), F.lit(1))
    allowed = F.array(*[F.lit(w) for w in ALLOWED_CAPITALS])
    return F.exists(inside, lambda w: w.rlike(TITLE) & ~F.array_contains(allowed, F.lower(w)))


def first_violation(t: Column | str) -> Column:
    """The name of the first rule that the text breaks; null if none."""
    t = col(t)
    low = F.lower(t)
    out = F.when(t.rlike("[—–]"), "dash").when(has_phone(t), "phone")
    for name, pattern in RULES:
        out = out.when((t if name in CASED else low).rlike(pattern), name)
    return out.when(low.rlike(PLACEHOLDER), "gender_placeholder").when(has_probable_name(t) | has_given_name(t), "possible_person_name")


def clean_text(t: Column | str) -> Column:
    """Blanks, dashes, numbering, enclosing quotes and bracketed endings put right; null is empty."""
    from .text import normalize

    t = normalize(F.coalesce(col(t), F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, " *[—–] *", " - "), r"^ *[0-9]{1,3}[.)] +", "")
    quoted = (F.length(t) > 2) & t.rlike('^["«“].*["»”]$')
    t = F.when(quoted, F.trim(F.substring(t, F.lit(2), F.length(t) - 2))).otherwise(t)
    return normalize(F.regexp_replace(t, REMOVED, ""))

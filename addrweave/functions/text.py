"""Names, house numbers and tags as column expressions (no Python runs per row)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that map to one Latin letter, and those that map to two.
CYR_LOWER = "абвгдежзијклмнопрстћуфхцчшђ"
LAT_LOWER = "abvgdežzijklmnoprstćufhcčšđ"
CYR_UPPER = "АБВГДЕЖЗИЈКЛМНОПРСТЋУФХЦЧШЂ"
LAT_UPPER = "ABVGDEŽZIJKLMNOPRSTĆUFHCČŠĐ"
LAT_MARKED, LAT_PLAIN = "čćžšČĆŽŠ", "cczsCCZS"
DIGRAPHS_LOWER = {"љ": "lj", "њ": "nj", "џ": "dž"}
DIGRAPHS_CAPITAL = {"Љ": "LJ", "Њ": "NJ", "Џ": "DŽ"}
DIGRAPHS_TITLE = {"Љ": "Lj", "Њ": "Nj", "Џ": "Dž"}
SERBIAN_ALPHABET = "АБВГДЂЕЖЗИЈКЛЉМНЊОПРСТЋУФХЦЧЏШ"

# Place of a house-number letter in the Latin alphabet, 1 to 30.
NUMBER_LETTERS = ["a", "b", "c", "č", "ć", "d", "dž", "đ", "e", "f", "g", "h", "i", "j", "k", "l", "lj", "m", "n", "nj",
                  "o", "p", "r", "s", "š", "t", "u", "v", "z", "ž"]

# Serbian month stems as they occur in street names.
MONTH_STEMS = ["јануар", "фебруар", "март", "април", "мај", "јун", "јул", "август", "септемб", "октоб", "новемб", "децемб"]

# Tag keys that do not turn an address node into something else.
SIMPLE_KEYS = ["note", "description", "entrance", "door", "survey:date", "survey_date", "check_date", "area", "TEXT_ANGLE", "TEXT_SIZE",
               "OBJECTID", "building", "building:levels", "old_name", "alt_name", "source:addr", "roof:levels", "old_addr:street",
               "old_addr:housenumber", "access", "source"]
# Tag keys that mark a point of interest.
POI_KEYS = ["shop", "amenity", "office", "healthcare", "tourism", "leisure", "craft", "sport", "power", "name", "name:sr-Latn", "wikidata",
            "image", "disused:shop", "disused:amenity"]

# Conjunctions and common nouns written small inside a name.
SMALL_INNER = ["И", "За", "Код"]
SMALL_WORDS = [
    "Баре", "Битке", "Бораца", "Брдо", "Брег", "Бригада", "Бригаде", "Бунара", "Венац", "Вијенац", "Воде", "Гај", "Дивизија", "Дивизије",
    "До", "Дом", "Други", "Друга", "Друм", "Језеро", "Јунака", "Засеок", "Зона", "Камен", "Каплара", "Комуне", "Коса", "Крај", "Крш", "Крша",
    "Лад", "Лаз", "Насеље", "Нова", "Њива", "Плато", "Поље", "Поток", "Прва", "Први", "Пруга", "Пруге", "Пука", "Пут", "Раван", "Ратника",
    "Револуције", "Реке", "Река", "Салаш", "Салаша", "Сокак", "Сокаче", "Стена", "Улица", "Фронта", "Јануар", "Јануара", "Фебруар",
    "Фебруара", "Март", "Марта", "Април", "Априла", "Мај", "Маја", "Јун", "Јуна", "Јул", "Јула", "Август", "Августа", "Септембар",
    "Септембра", "Октобар", "Октобра", "Новембар", "Новембра", "Децембар", "Децембра",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _swap(c: Column, pairs: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), pairs.items(), c)


def _bare(c: Column | str) -> Column:
    return F.lower(F.translate(_col(c), " .-", ""))


def norm(c: Column | str) -> Column:
    """comparison form, ASCII letters only; blanks, dots and dashes dropped."""
    one = F.translate(_bare(c), CYR_LOWER[:-1] + LAT_MARKED[:4], "abvgdezzijklmnoprstcufhccs" + LAT_PLAIN[:4])
    return _swap(one, {"љ": "lj", "њ": "nj", "џ": "dz", "ђ": "dj", "đ": "dj"})


def norm_latin(c: Column | str) -> Column:
    """comparison form that keeps diacritics."""
    return _swap(F.translate(_bare(c), CYR_LOWER, LAT_LOWER), DIGRAPHS_LOWER)


def cyr2lat(c: Column | str) -> Column:
    """transliterate; capital digraphs become two capitals."""
    return _swap(F.translate(_col(c), CYR_LOWER + CYR_UPPER, LAT_LOWER + LAT_UPPER), {**DIGRAPHS_LOWER, **DIGRAPHS_CAPITAL})


def cyr2lat_small(c: Column | str) -> Column:
    """transliterate; capital digraphs become capital + small."""
    return _swap(F.translate(_col(c), CYR_LOWER + CYR_UPPER, LAT_LOWER + LAT_UPPER), {**DIGRAPHS_LOWER, **DIGRAPHS_TITLE})


def cyr2intname(c: Column | str) -> Column:
    """international form of Cyrillic letters; Latin letters pass unchanged."""
    plain = F.translate(_col(c), CYR_LOWER[:-1] + CYR_UPPER[:-1], "abvgdezzijklmnoprstcufhccs" + "ABVGDEZZIJKLMNOPRSTCUFHCCS")
    return _swap(plain, {"љ": "lj", "њ": "nj", "џ": "dz", "ђ": "dj", "Љ": "Lj", "Њ": "Nj", "Џ": "Dz", "Ђ": "Dj"})


def xml_escape(c: Column | str) -> Column:
    """the five XML entities, ampersand first."""
    return _swap(_col(c).cast("string"), {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;"})


def _lpad5(c: Column) -> Column:
    return F.when(F.length(c) >= 5, c).otherwise(F.lpad(c, 5, "0"))


def pad_house_number(c: Column | str) -> Column:
    """sortable text, digits padded to five places, a one- or two-letter suffix kept."""
    h = _col(c)
    n = F.length(h)
    letters = F.when(n <= 1, 0).when(h.rlike(r"\d$"), 0).when(h.rlike(r"\d\D$"), 1).otherwise(2)
    body = F.substring(h, F.lit(1), n - letters)
    return F.when(h.isNull() | (h == ""), "00000").otherwise(F.concat(_lpad5(body), F.substring(h, n - letters + 1, F.lit(2))))


def house_number_order(c: Column | str) -> Column:
    """F8: number plus letter place / 30, rounded to 3; an unknown letter adds nothing."""
    h = F.coalesce(_col(c), F.lit(""))
    number = F.coalesce(F.regexp_extract(h, r"^(\d*)", 1).try_cast("double"), F.lit(0.0))
    letter = F.regexp_extract(h, r"^\d*(\D{0,2})$", 1)
    place = F.array_position(F.array(*[F.lit(x) for x in NUMBER_LETTERS]), letter)
    return F.when(place > 0, F.round(number + place / F.lit(30.0), 3)).otherwise(number)


def house_number_int(c: Column | str) -> Column:
    """null is -1, digits with at most one other last character are that number, else null."""
    h = _col(c)
    return (F.when(h.isNull(), F.lit(-1).cast("long"))
            .when(h.rlike(r"^[0-9]+.?$"), F.regexp_extract(h, r"^([0-9]+)", 1).try_cast("long")))


def address_number_match(street_l: Column, street_r: Column, number_l: Column, number_r: Column) -> Column:
    """same street (or both absent) and same readable number."""
    return street_l.eqNullSafe(street_r) & F.coalesce(house_number_int(number_l) == house_number_int(number_r), F.lit(False))


def _title(c: Column) -> Column:
    """Capital after every non-letter, small elsewhere."""
    chars = F.split(F.lower(c), "")
    before = F.concat(F.array(F.lit(" ")), chars)
    return F.array_join(F.zip_with(F.slice(before, F.lit(1), F.size(chars)), chars,
                                   lambda p, x: F.when(p.rlike(r"\p{L}"), x).otherwise(F.upper(x))), "")


def decapitalize(c: Column | str) -> Column:
    """title case, then small conjunctions and common nouns where they are not the first word."""
    t = _title(_col(c))
    dotted = t.contains(".") & ~t.contains(". ") & t.rlike(r"^\d+\.")
    words = F.split(F.when(dotted, F.regexp_replace(t, r"^(\d+\.)", "$1 ")).otherwise(t), " ", -1)
    last = F.size(words) - 1
    inner, nouns = F.array(*[F.lit(w) for w in SMALL_INNER]), F.array(*[F.lit(w) for w in SMALL_WORDS])
    small = F.transform(words, lambda w, i: F.when(
        (i > 0) & (((i < last) & F.array_contains(inner, w)) | F.array_contains(nouns, w)), F.lower(w)).otherwise(w))
    return F.array_join(small, " ")


def squeeze(c: Column | str) -> Column:
    """right-trimmed, runs of blanks made one."""
    return F.regexp_replace(F.rtrim(_col(c)), " {2,}", " ")


def is_cyrillic(c: Column | str) -> Column:
    """F16: no Latin vowel in the name."""
    return ~_col(c).rlike("[aeiou]")


def norm_keep_case(c: Column | str) -> Column:
    """blanks and dots dropped, case kept."""
    return F.translate(_col(c), " .", "")


def removal_date(note: Column | str, authority: str = "RGZ") -> Column:
    """date after the removal text in a ``;``-separated note; null where it is no date."""
    mark = f"Izbrisano iz {authority}-a"
    part = F.filter(F.split(_col(note), ";"), lambda p: p.contains(mark))
    first = F.when(F.size(part) > 0, F.element_at(part, 1))
    return F.to_date(F.try_to_timestamp(F.regexp_extract(first, mark + r" (\d{4}-\d{2}-\d{2})$", 1), F.lit("yyyy-MM-dd")))


def first_number(c: Column | str) -> tuple[Column, Column]:
    """first digit run as a number and whether a dot follows it."""
    return (F.regexp_extract(_col(c), r"([0-9]+)", 1).try_cast("long"), F.regexp_extract(_col(c), r"[0-9]+(\.?)", 1) == ".")


def has_month(c: Column | str) -> Column:
    """a month stem anywhere in the lower-cased name."""
    return F.lower(_col(c)).rlike("|".join(MONTH_STEMS))


def serbian_sort_key(c: Column | str) -> Column:
    """upper-cased text whose code points sort as the Serbian alphabet, after all other letters below U+E000."""
    shifted = "".join(chr(0xE000 + i) for i in range(len(SERBIAN_ALPHABET)))
    return F.translate(F.upper(_col(c)), SERBIAN_ALPHABET, shifted)


def osm_type(c: Column | str) -> Column:
    """entity type named by the id prefix."""
    p = F.substring(_col(c), 1, 1)
    return F.when(p == "n", "node").when(p == "w", "way").when(p.isNotNull(), "relation")


def osm_link(c: Column | str, site: str = "https://www.openstreetmap.org") -> Column:
    """link to the entity."""
    c = _col(c)
    return F.concat(F.lit(site + "/"), osm_type(c), F.lit("/"), F.substring(c, F.lit(2), F.length(c)))


def is_hamlet(code: Column | str) -> Column:
    """seventh character of the street code is 2."""
    return F.substring(_col(code), 7, 1) == "2"


def mark_partial(c: Column | str) -> Column:
    """``~~x~~`` emphasised."""
    return F.regexp_replace(_col(c), "~~(.*?)~~", "<b>$1</b>")


def show_blank(c: Column | str) -> Column:
    """one leading and one trailing blank made visible."""
    return F.regexp_replace(_col(c), "^ | $", "␣")


def strip_id(c: Column | str, pattern: str) -> Column:
    """drop a register prefix from an id."""
    return F.regexp_replace(_col(c), pattern, "")


def tag(tags: Column | str, key: str) -> Column:
    """tag value or the empty text."""
    return F.coalesce(F.try_element_at(_col(tags), F.lit(key)), F.lit(""))


def is_simple_address(tags: Column | str, street_ref: str = "ref:RS:ulica", house_ref: str = "ref:RS:kucni_broj") -> Column:
    """every key belongs to an address."""
    allowed = F.array(*[F.lit(k) for k in SIMPLE_KEYS + [street_ref, house_ref, f"removed:{house_ref}"]])
    return F.forall(F.map_keys(_col(tags)), lambda k: k.startswith("addr:") | F.array_contains(allowed, k))


def is_poi(tags: Column | str) -> Column:
    """any key marks a point of interest."""
    return F.arrays_overlap(F.map_keys(_col(tags)), F.array(*[F.lit(k) for k in POI_KEYS]))


def tag_text(**tags: Column) -> Column:
    """one ``key=value`` line per non-empty tag."""
    return F.concat_ws("\n", *[F.when(v.isNotNull() & (v != ""), F.concat(F.lit(k + "="), v)) for k, v in tags.items()])

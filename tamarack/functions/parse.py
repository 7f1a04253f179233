"""Scalar parsers of collected text, as column expressions. Unparsable input gives null (or empty, where said)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.text import collapse, strip_accents


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null if there is none."""
    return F.when(F.coalesce(c, F.lit("")).rlike(pattern), F.regexp_extract(c, pattern, group))


def clean_text(c: Column) -> Column:
    return collapse(F.regexp_replace(F.regexp_replace(c, "\ufeff", ""), "\u00a0", " "))


def clean_cell(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\ufeff", "")), '^"|"$', "")


def norm_url(c: Column) -> Column:
    return F.substring_index(F.trim(F.coalesce(c, F.lit(""))), "#", 1)


def apply_domain(c: Column, domain: str) -> Column:
    return F.regexp_replace(c, r"^https?://[^/?#]+", domain.rstrip("/"))


def parse_rating(c: Column) -> Column:
    v = F.replace(_found(c, r"(\d+(?:[.,]\d+)?)"), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(v.between(1.0, 5.0), v)


def to_float(c: Column) -> Column:
    return _found(F.replace(F.trim(c), F.lit(","), F.lit(".")), r"(-?\d+(?:\.\d+)?)").try_cast("double")


def to_int(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit("")).try_cast("long")


def strict_int(c: Column) -> Column:
    return F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).try_cast("long"))


def parse_count(c: Column) -> Column:
    """``1,2K`` -> 1200 (truncated); without a suffix, the digits."""
    text = F.upper(clean_text(c))
    number = F.replace(_found(text, r"([0-9.,]+)\s*([KMB])"), F.lit(","), F.lit(".")).try_cast("double")
    unit = _found(text, r"([0-9.,]+)\s*([KMB])", 2)
    return F.when(unit.isNotNull(), F.floor(number * F.when(unit == "K", 1e3).when(unit == "M", 1e6).otherwise(1e9)).cast("long")).otherwise(to_int(text))


def parse_count_rounded(c: Column) -> Column:
    """The browser's variant: the number ends at a comma, and the product is rounded."""
    text = F.upper(clean_text(c))
    number = _found(text, r"([0-9]+(?:\.[0-9]+)?)[0-9.,]*\s*[KMB]").try_cast("double")
    unit = _found(text, r"([0-9.,]+)\s*([KMB])", 2)
    return F.when(unit.isNotNull(), F.round(number * F.when(unit == "K", 1e3).when(unit == "M", 1e6).otherwise(1e9)).cast("long")).otherwise(to_int(text))


_HOURS = r"(\d{1,2}:\d{2})\s*[-–—]\s*(\d{1,2}:\d{2})"


def opening_hours(c: Column) -> Column:
    """``struct(open, close)`` of the first range; empty if none."""
    text = F.coalesce(c, F.lit(""))
    return F.struct(F.regexp_extract(text, _HOURS, 1).alias("open"), F.regexp_extract(text, _HOURS, 2).alias("close"))


_PRICE = r"(?iu)(\d[\d.,]*)\s*(k|nghìn|ngàn|triệu|tr)?"


def price_range(c: Column) -> Column:
    """``struct(low, high)`` of all amounts above zero; one amount has no high."""
    text = F.coalesce(c, F.lit(""))
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(_PRICE), F.lit(1)).alias("n"), F.regexp_extract_all(text, F.lit(_PRICE), F.lit(2)).alias("u"))
    value = lambda p: F.regexp_replace(p["n"], "[.,]", "").try_cast("long") * F.when(F.lower(p["u"]).isin("k", "nghìn", "ngàn"), 1000).when(F.lower(p["u"]).isin("triệu", "tr"), 1_000_000).otherwise(1)
    own = F.filter(F.transform(pairs, value), lambda v: v > 0)
    return F.struct(F.array_min(own).alias("low"), F.when(F.size(own) > 1, F.array_max(own)).alias("high"))


def parse_price(c: Column) -> Column:
    """The first amount before a currency, else the first number."""
    amount = F.coalesce(_found(c, r"(?iu)(\d+(?:[.,]\d+)*)\s*(?:đ|₫|vnd)"), _found(c, r"(\d+(?:[.,]\d+)*)"))
    return F.regexp_replace(amount, "[.,]", "").try_cast("long")


def parse_duration(c: Column) -> Column:
    """Minutes."""
    text = F.lower(c)
    h, m = _found(text, r"(\d+)\s*h").try_cast("int"), _found(text, r"(\d+)\s*(?:m|p|phút)").try_cast("int")
    return F.when(h.isNotNull() | m.isNotNull(), F.coalesce(h, F.lit(0)) * 60 + F.coalesce(m, F.lit(0))).otherwise(_found(text, r"(\d+)").try_cast("int"))


def is_time(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(r"^\d{1,2}:\d{2}$"), F.lit(False))


def address(c: Column) -> Column:
    """``struct(address, district, city)`` from comma parts."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), collapse), lambda x: x != "")
    n = F.size(parts)
    return F.struct(
        F.when(n >= 3, F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 2, F.lit(1))), ", ")).otherwise(F.coalesce(F.get(parts, F.lit(0)), F.lit(""))).alias("address"),
        F.when(n >= 3, F.get(parts, n - 2)).when(n == 2, F.get(parts, F.lit(1))).otherwise("").alias("district"),
        F.when(n >= 3, F.get(parts, n - 1)).otherwise("").alias("city"),
    )


def normalize_path(c: Column) -> Column:
    path = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"^/\(S\([^)]*\)\)", "")
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "").otherwise(F.concat(F.lit("/"), F.regexp_replace(path, "^/(?!/)|^//+", "")))


def province_slug(c: Column) -> Column:
    path = F.regexp_extract(F.regexp_replace(F.coalesce(c, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"^[^?#]*", 0)
    return F.coalesce(F.get(F.filter(F.split(normalize_path(path), "/"), lambda x: x != ""), F.lit(0)), F.lit(""))


def is_vn_coordinate(lat: Column, lng: Column) -> Column:
    return F.coalesce(lat.between(8.0, 24.0) & lng.between(102.0, 110.5), F.lit(False))


def coordinates(image: Column, frame: Column, lat: Column, lng: Column, url: Column) -> Column:
    """``struct(lat, lng)``: map image (degrees times 10**7), map frame, microdata, page address, in this order."""
    e7 = r"!4m2!1x(-?\d+)!2x(-?\d+)"
    q, at = r"[?&]q=(-?\d+\.\d+),(-?\d+\.\d+)", r"@(-?\d+\.\d+),(-?\d+\.\d+)"
    by = lambda g, own: F.coalesce(F.round(_found(image, e7, g).try_cast("double") / 1e7, 7), _found(frame, q, g).try_cast("double"), own, _found(url, at, g).try_cast("double"))
    return F.struct(by(1, lat).alias("lat"), by(2, lng).alias("lng"))


#: Rating fields and the accent-free words of their labels, in order.
RATING_LABELS = (("rating_quality", ("chat luong",)), ("rating_price", ("gia ca", "gia")), ("rating_service", ("phuc vu",)), ("rating_space", ("khong gian",)), ("rating_location", ("vi tri",)))


def rating_field(label: Column) -> Column:
    plain = strip_accents(label)
    out = F.lit(None).cast("string")
    for name, words in reversed(RATING_LABELS):
        hit = F.lit(False)
        for w in words:
            hit = hit | plain.contains(w)
        out = F.when(hit, name).otherwise(out)
    return out


#: The fields of ratings without a label, by place.
RATING_ORDER = ("rating_quality", "rating_price", "rating_location", "rating_service", "rating_space")


def rating_fields(groups: Column) -> Column:
    """``array<struct<label, value>>`` -> a struct of the five fields. A blank label stands for the field of its place; the first value of
    a field counts."""
    order = F.array(*[F.lit(x) for x in RATING_ORDER])
    plain = lambda g: F.trim(F.coalesce(g["label"], F.lit("")))
    named = F.transform(groups, lambda g, i: F.struct(F.when(plain(g) != "", rating_field(g["label"])).otherwise(F.get(order, i)).alias("field"), to_float(g["value"]).alias("value")))
    of = lambda name: F.get(F.filter(named, lambda g: g["field"] == F.lit(name)), F.lit(0))["value"]
    return F.struct(*[of(name).alias(name) for name, _ in RATING_LABELS])


#: Parts of a path that are no place's page.
LINK_PARTS = ("/thuong-hieu/", "/nearBy", "/binh-luan", "/hinh-anh", "/menu")


def detail_path(c: Column, excluded: tuple[str, ...] = LINK_PARTS) -> Column:
    """The normalized path of a place's page (province and name at least); null for other links."""
    path = normalize_path(c)
    ok = F.size(F.filter(F.split(path, "/"), lambda x: x != "")) >= 2
    for part in excluded:
        ok = ok & ~path.contains(part)
    return F.when(ok, path)


def upgrade_photo(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"/photo-[a-z]\d*/", "/photo-o/"), r"-\d{2,4}x\d{2,4}\.jpg$", ".jpg")


def photo_key(c: Column) -> Column:
    """Equal for two addresses of one picture; null if it is none."""
    return _found(c, r"/media/photo-[a-z]\d*/([\w/]+?)\.jpg")


def srcset_last(c: Column) -> Column:
    return F.get(F.split(F.trim(F.element_at(F.split(c, ","), -1)), r"\s+"), F.lit(0))


def video_id(c: Column) -> Column:
    return F.coalesce(_found(c, r"/video/(\d+)"), F.lit(""))


def province_suffix(c: Column, provinces: list[str]) -> Column:
    """The longest listed province that a keyword ends with, whatever the case."""
    low = F.lower(clean_text(c))
    out = F.lit("")
    for p in sorted(provinces, key=len):
        out = F.when(low.endswith(p.lower()), p).otherwise(out)
    return out


#: Buttons under a comment.
_JUNK = ("Reply", "Trả lời", "Like", "Thích", "Xem bản dịch", "See translation", "Xem thêm", "See more")


#: Dates, buttons and counts behind a comment, in order.
RESIDUE = (r"\s+\d{1,2}-\d{1,2}(\s+\d{4})?\s*$", r"\s+\d{4}-\d{2}-\d{2}\s*$", r"(?iu)\s*(Trả lời|Reply)\s*\d*\s*$", r"(?iu)\s*(Thích|Like)\s*\d*\s*$", r"\s+\d+\s*$")


def comment_residue(c: Column, author: Column | None = None) -> Column:
    """Comment text without the author before it and the dates, buttons and counts behind it; null if nothing is left."""
    text = clean_text(c)
    if author is not None:
        text = F.when(F.coalesce(author, F.lit("")).eqNullSafe("") | ~text.startswith(author), text).otherwise(F.trim(F.substr(text, F.length(author) + 1)))
    for pattern in RESIDUE:
        text = F.regexp_replace(text, pattern, "")
    text = clean_text(text)
    return F.when((F.length(text) >= 2) & ~text.isin(*_JUNK), text)


def hashtags(c: Column) -> Column:
    return F.array_join(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"#[\p{L}\p{N}_]+"), F.lit(0))), "|")


def md5_id(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[clean_text(p) for p in parts]))


def card_id(author: Column, description: Column, date: Column) -> Column:
    return F.substring(F.base64(F.encode(F.concat_ws("|", author, description, date), "UTF-8")), 1, 32)


def entity_id(name: Column, province: Column) -> Column:
    part = lambda c: F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))
    return F.concat_ws("__", part(province), part(name))


def rank_and_name(c: Column) -> Column:
    """``3. Name`` -> ``struct(rank, name)``; without a number the rank is null."""
    p = r"^(\d+)\.\s*(.+)$"
    return F.struct(_found(c, p).try_cast("int").alias("rank"), F.coalesce(_found(c, p, 2), c).alias("name"))


def compression_ratio(compressed: Column, original: Column) -> Column:
    return F.round(compressed / F.nullif(original, F.lit(0)), 4)


#: Fixed values of ticket cards, in order of preference.
SEATS = ("Ngồi mềm", "Ngồi cứng", "Giường khoang 4", "Giường khoang 6", "Giường nằm")
AIRLINES = ("Vietnam Airlines", "VietJet Air", "Vietjet Air", "Bamboo Airways", "Pacific Airlines", "Vietravel Airlines", "VietJet", "Bamboo")
FARES = ("Deluxe", "SkyBoss", "Business", "Eco", "Phổ thông", "Bay thẳng")


def _first_of(c: Column, words: tuple[str, ...], default: Column) -> Column:
    out = default
    for w in reversed(words):
        out = F.when(F.lower(c).contains(w.lower()), w.replace("Vietjet", "VietJet")).otherwise(out)
    return out


def _times(c: Column) -> list[Column]:
    times = F.regexp_extract_all(c, F.lit(r"\b(\d{1,2}:\d{2})\b"), F.lit(1))
    return [F.coalesce(F.get(times, F.lit(k)), F.lit("")).alias(n) for k, n in ((0, "departure_time"), (1, "arrival_time"))]


#: Numbers of trains and flights.
TRAIN_NUMBER = r"(?i)\b(?:Tàu\s+)?(SE\d+|SNT\d+|TN\d+|SPT\d+)\b"
FLIGHT_NUMBER = r"\b((?:VJ|VN|QH|VU|BL)\d+)\b"


def train_card(c: Column) -> Column:
    """Fields of a train card; null if it is too short or has no departure."""
    number = _found(c, TRAIN_NUMBER)
    from_k = F.floor(F.replace(_found(c, r"[Tt]ừ\s*(\d+(?:[.,]\d+)?)\s*[Kk]"), F.lit(","), F.lit(".")).try_cast("double") * 1000).cast("long")
    dep, arr = _times(c)
    row = F.struct(dep, arr, F.coalesce(F.concat(F.lit("Tàu "), F.upper(number)), F.lit("Vietnam Railways")).alias("operator_name"), _first_of(c, SEATS, F.lit("Unknown")).alias("vehicle_type"), F.coalesce(from_k, parse_price(c)).alias("price_vnd"), parse_duration(c).alias("duration_min"))
    return F.when((F.length(F.trim(c)) >= 20) & is_time(row["departure_time"]), row)


def flight_card(c: Column) -> Column:
    dep, arr = _times(c)
    row = F.struct(dep, arr, _first_of(c, AIRLINES, F.lit("Unknown")).alias("operator_name"), F.coalesce(_found(c, FLIGHT_NUMBER), _first_of(c, FARES, F.lit("Unknown"))).alias("vehicle_type"), parse_price(c).alias("price_vnd"), parse_duration(c).alias("duration_min"))
    return F.when((F.length(F.trim(c)) >= 30) & is_time(row["departure_time"]), row)


def booking_url(url: Column, crawl_date: Column, kind: Column) -> Column:
    """The address with the date of travel; other parameters stay, dates before are dropped."""
    base = F.regexp_extract(url, r"^[^?#]*", 0)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"#.*$", 0)
    pairs = F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.url_decode(F.substring_index(x, "=", 1)).rlike(r"^(date|lt|lf)$|^date\["))
    names = F.transform(pairs, lambda x: F.url_decode(F.substring_index(x, "=", 1)))
    iso = F.when(crawl_date.rlike(r"^[^-]*-[^-]*-[^-]*$"), F.concat_ws("-", F.split_part(crawl_date, F.lit("-"), F.lit(3)), F.split_part(crawl_date, F.lit("-"), F.lit(2)), F.split_part(crawl_date, F.lit("-"), F.lit(1)))).otherwise(crawl_date)
    put = lambda k, v, when=F.lit(True): F.when(when & ~F.array_contains(names, k), F.array(F.concat(F.url_encode(F.lit(k)), F.lit("="), F.url_encode(v)))).otherwise(F.array().cast("array<string>"))
    flight = kind == "flight"
    bus = F.concat(put("date", crawl_date), put("lt", F.lit("1")))
    other = F.concat(put("date[depart]", iso), put("passenger[adt]", F.lit("1")), put("passenger[chd]", F.lit("0")), put("passenger[inf]", F.lit("0"), flight), put("fare_class", F.lit("PT"), flight), *[put(f"passenger[{k}]", F.lit("0"), ~flight) for k in ("eld", "stu", "uni")])
    return F.concat(base, F.lit("?"), F.array_join(F.concat(pairs, F.when(kind == "bus", bus).otherwise(other)), "&"), fragment)


def parse_index_tokens(tokens: list[str], total: int) -> list[int]:
    """``["0-4", "9"]`` -> positions, ascending and once each; reversed ranges are turned round; others raise IndexError."""
    out: set[int] = set()
    for part in (p.strip() for t in tokens for p in str(t).split(",")):
        if not part:
            continue
        if m := re.fullmatch(r"(\d+)\s*-\s*(\d+)", part):
            a, b = sorted(map(int, m.groups()))
            out.update(range(a, b + 1))
        elif re.fullmatch(r"[+-]?\d+", part):
            out.add(int(part))
        else:
            raise IndexError(f"not an index: {part!r}")
    if bad := [i for i in out if not 0 <= i < total]:
        raise IndexError(f"outside 0..{total - 1}: {sorted(bad)}")
    return sorted(out)

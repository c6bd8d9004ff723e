"""Dates: of logs, of publications, lunar ones, and made-up ones that a rerun repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the sexagenary cycle, the zodiac, lunar months and days.
STEMS = "甲乙丙丁戊己庚辛壬癸"
BRANCHES = "子丑寅卯辰巳午未申酉戌亥"
ZODIAC = "鼠牛虎兔龙蛇马羊猴鸡狗猪"
MONTHS = ("正月", "二月", "三月", "四月", "五月", "六月", "七月", "八月", "九月", "十月", "十一月", "腊月")
DIGITS = "一二三四五六七八九"
TENS = "十廿卅"
CITIES = ("北京", "上海", "广州", "深圳", "成都", "杭州", "重庆", "武汉", "西安", "苏州")


def pick(values, *seed: Column) -> Column:
    """One of ``values`` by the hash of ``seed``: the same in every run."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64(*seed), F.lit(len(values))) + 1).cast("int"))


def number(low: int, high: int, *seed: Column) -> Column:
    """A whole number from low to high by the hash of ``seed``."""
    return (F.pmod(F.xxhash64(*seed), F.lit(high - low + 1)) + low).cast("int")


def parse_chinese_date(text: Column) -> Column:
    """``2024年3月5日`` as a date; null if it is none."""
    return F.try_to_date(F.regexp_extract(text, r"(\d{4}年\d{1,2}月\d{1,2}日)", 1), "y年M月d日")


def chinese_date(day: Column) -> Column:
    return F.date_format(day, "y年M月d日")


def dates_in(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1)), lambda x: F.try_to_date(x, "yyyy-MM-dd"))


def last_published(passages: Column) -> Column:
    """The latest date in a list of passages; null without one."""
    return F.array_max(F.flatten(F.transform(passages, dates_in)))


def random_date(start: str, end: str, *seed: Column) -> Column:
    days = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date"))
    return F.date_add(F.lit(start).cast("date"), F.pmod(F.xxhash64(*seed), days + 1).cast("int"))


def asked_on(passages: Column, *seed: Column, start: str = "2020-01-01", end: str = "2026-12-31") -> Column:
    """1 to 30 days after the latest publication in a call's lists of passages, or 1 to 2 days after a random date."""
    known = last_published(F.flatten(passages))
    return F.when(known.isNotNull(), F.date_add(known, number(1, 30, *seed, F.lit("d")))).otherwise(F.date_add(random_date(start, end, *seed), number(1, 2, *seed, F.lit("d"))))


def cycle_name(year: Column) -> Column:
    """Stem and branch of a lunar year."""
    at = lambda names, shift: F.substring(F.lit(names), (F.pmod(year - 4, F.lit(shift)) + 1).cast("int"), F.lit(1))
    return F.concat(at(STEMS, 10), at(BRANCHES, 12))


def zodiac(year: Column) -> Column:
    return F.substring(F.lit(ZODIAC), (F.pmod(year - 4, F.lit(12)) + 1).cast("int"), F.lit(1))


def lunar_day(day: Column) -> Column:
    """初一 to 卅; the twentieth and thirtieth are their tens alone."""
    digit = lambda n: F.substring(F.lit(DIGITS), n.cast("int"), F.lit(1))
    tens = F.substring(F.lit(TENS), F.floor(day / 10).cast("int"), F.lit(1))
    return F.when(day == 10, "初十").when(day < 10, F.concat(F.lit("初"), digit(day))).when(day % 10 == 0, tens).otherwise(F.concat(tens, digit(day % 10)))


def lunar_text(year: Column, month: Column, day: Column) -> Column:
    """The sentence of a lunar date; a leap month has its month's name."""
    name = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month.cast("int"))
    return F.concat(F.lit("用户今天农历："), cycle_name(year), F.lit("年，"), zodiac(year), F.lit("年，"), name, lunar_day(day), F.lit("。"))


#: Mean lunation in days, and the mean new moon of 6 January 2000, 18:14 UTC, as a Julian day.
LUNATION, NEW_MOON = 29.530588861, 2451550.09766


def _new_moon(k: int) -> float:
    """The Julian day of the k-th new moon from 2000 on, with the largest periodic terms."""
    import math

    c = k / 1236.85
    rad = lambda x: math.radians(x % 360)
    sun, moon = rad(2.5534 + 29.10535670 * k - 1.4e-6 * c * c), rad(201.5643 + 385.81693528 * k + 0.0107582 * c * c)
    lat, node = rad(160.7108 + 390.67050284 * k - 0.0016118 * c * c), rad(124.7746 - 1.56375588 * k + 0.0020672 * c * c)
    e = 1 - 0.002516 * c
    day = NEW_MOON + LUNATION * k + 0.00015437 * c * c
    terms = (
        (-0.40720, moon, 0), (0.17241, sun, 1), (0.01608, 2 * moon, 0), (0.01039, 2 * lat, 0), (0.00739, moon - sun, 1), (-0.00514, moon + sun, 1), (0.00208, 2 * sun, 2), (-0.00111, moon - 2 * lat, 0),
        (-0.00057, moon + 2 * lat, 0), (0.00056, 2 * moon + sun, 1), (-0.00042, 3 * moon, 0), (0.00042, sun + 2 * lat, 1), (0.00038, sun - 2 * lat, 1), (-0.00024, 2 * moon - sun, 1), (-0.00017, node, 0),
    )
    return day + sum(a * e**n * math.sin(x) for a, x, n in terms)


def _sun_longitude(jd: float) -> float:
    """The sun's apparent longitude in degrees."""
    import math

    c = (jd - 2451545.0) / 36525
    mean, anomaly = 280.46646 + 36000.76983 * c + 0.0003032 * c * c, math.radians(357.52911 + 35999.05029 * c - 0.0001537 * c * c)
    centre = (1.914602 - 0.004817 * c) * math.sin(anomaly) + (0.019993 - 0.000101 * c) * math.sin(2 * anomaly) + 0.000289 * math.sin(3 * anomaly)
    return (mean + centre - 0.00569 - 0.00478 * math.sin(math.radians(125.04 - 1934.136 * c))) % 360


def lunar_months(first: int, last: int) -> list[tuple[str, int, int]]:
    """(first day, lunar year, month) of each lunar month, from the moon's and the sun's positions in
    Beijing time. The month with the winter solstice is the eleventh; in a year of thirteen months
    the first without one of the twelve principal terms repeats the number before it."""
    from datetime import date, timedelta
    from math import floor

    beijing = lambda jd, year: floor(jd + (8 + 0.5 * 24 - (64 + 0.4 * (year - 2000)) / 3600) / 24)
    k0 = floor((first - 2001) * 12.3685) - 3
    days = [beijing(_new_moon(k), 2000 + k / 12.3685) for k in range(k0, k0 + (last - first + 4) * 13)]
    term = lambda day: floor(_sun_longitude(day - 0.5 - 8 / 24) / 30)  # at Beijing's midnight
    solstice = [i for i, (a, b) in enumerate(zip(days, days[1:], strict=False)) if 7 <= term(a) < 9 <= term(b)]
    out = []
    for a, b in zip(solstice, solstice[1:], strict=False):
        year = (date(2000, 1, 1) + timedelta(days=days[a] - 2451545)).year
        leap = next((i for i in range(a + 1, b) if term(days[i]) == term(days[i + 1])), None) if b - a == 13 else None
        month, lunar = 11, year
        for i in range(a, b):
            if i > a and i != leap:
                month = month % 12 + 1
                lunar = year + 1 if month == 1 else lunar
            out.append(((date(2000, 1, 1) + timedelta(days=days[i] - 2451545)).isoformat(), lunar, month))
    return [m for m in out if first - 1 <= int(m[0][:4]) <= last]


def with_lunar(df: DataFrame, day: str, first: int = 1900, last: int = 2100) -> DataFrame:
    """The lunar sentence of a solar date, by a table of about 2,500 months."""
    spark: SparkSession = df.sparkSession
    months = lunar_months(first, last)
    ends = [m[0] for m in months[1:]] + [None]
    table = spark.createDataFrame([(*m, e) for m, e in zip(months, ends, strict=True)], "start string, lunar_year int, lunar_month int, next string")
    # A row a day, so that the join is on equality.
    daily = table.filter("next is not null").select(F.explode(F.sequence(F.col("start").cast("date"), F.date_sub(F.col("next").cast("date"), 1))).alias(day), F.col("start").cast("date").alias("_s"), "lunar_year", "lunar_month")
    text = lunar_text(F.col("lunar_year"), F.col("lunar_month"), F.datediff(F.col(day), F.col("_s")) + 1)
    return df.join(daily.select(day, text.alias("lunar")), day, "left")


def system_prompt(day: Column, lunar: Column, *seed: Column) -> Column:
    """Date, lunar date, a random time and a random city, for a synthetic system message."""
    clock = F.concat(number(0, 23, *seed, F.lit("h")).cast("string"), F.lit("时"), number(0, 59, *seed, F.lit("m")).cast("string"), F.lit("分"))
    return F.concat(F.lit("用户今天日期："), chinese_date(day), F.lit("。"), lunar, F.lit("用户现在时间："), clock, F.lit("。用户现在位置："), pick(CITIES, *seed, F.lit("c")), F.lit("。"))


def date_list(start: Column, end: Column) -> Column:
    """Every day from start to end, both included."""
    return F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))

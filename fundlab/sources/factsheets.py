"""Portfolio turnover of fund companies' factsheets, from page texts and from word boxes.

Texts: every company has rules in an order; the first one that hits decides. All rules of a
company are one expression over its own page texts, so a page is read once and nothing is shuffled.

Word boxes: where a page's text is torn by its columns, a label of one or two words is looked for by place, then the
number beside or below it. Boxes of a page meet in bands of BAND points, so a label meets the words near
its line and not all words of its page.

Values at or below 0 and those at or above a rule's limit do not count. Pages of other companies, null texts and
null places give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Height of a band in points.
BAND = 8

# Company, pattern of one number, its scale, whether 0 and less count too. Rules of one company in the order of their rank.
TEXT_RULES = [
    ("absl", r"(?i)Portfolio\s+Turnover\s+(\d+\.\d+)", 1.0, True),
    ("bank_of_india", r"(?is)PORTFOLIO\s+TURNOVER\s+RATIO.{0,250}?(\d+\.\d+)\s*Times", 1.0, False),
    ("canara_robeco", r"(?i)Portfolio\s+Turnover\s+Ratio\s*\(Equity\)\s+(\d+(?:\.\d+)?)\s*times", 1.0, False),
    ("canara_robeco", r"(?i)Portfolio\s+Turnover\s+Ratio\s+(\d+(?:\.\d+)?)\s*times", 1.0, False),
    ("edelweiss", r"(?i)Portfolio\s+Turnover\s+Ratio[\d,\s\^]*[:\-]?\s*(\d+\.\d+)", 1.0, False),
    ("franklin", r"(?i)Portfolio\s+Turnover\s*\(Equity\)[\s\$\*\^\#@]*(\d+(?:\.\d+)?)\s*%", 0.01, False),
    ("franklin", r"(?i)Portfolio\s+Turnover\s*[\s\$\*\^\#@]*(\d+(?:\.\d+)?)\s*%", 0.01, False),
    ("hdfc", r"(?i)Equity\s+Turnover\s+(\d+(?:\.\d+)?)\s*%", 0.01, False),
    ("icici_pru", r"(?i)Equity\s*[-–]\s*(\d+\.\d+)\s*times", 1.0, True),
    ("iti", r"(?i)Portfolio\s+Turnover\s+Ratio\s+(\d+(?:\.\d+)?)", 1.0, False),
    ("kotak", r"(?i)Portfolio\s+Turnover\s+(\d+(?:\.\d+)?)\s*%", 0.01, False),
    ("lic", r"(?i)Annual\s+(?:Equity\s+)?Portfolio\s+Turnover\s+Ratio\s*:\s*(\d+\.\d+)\s*times", 1.0, False),
    ("mahindra_manulife", r"(?i)Portfolio\s+Turnover\s+Ratio\s*\(Last\s+(?:one|1)\s+year\)\s*:?\s*(\d+\.\d+)", 1.0, False),
    ("mirae", r"(?i)Portfolio\s+Turnover(?:\s+Ratio)?\s+(\d+\.\d+)\s*[Tt]imes", 1.0, False),
    ("motilal_oswal", r"(?i)Portfolio\s+Turnover\s+Ratio\s+([\-]?\d+(?:\.\d+)?)", 1.0, False),
    ("nippon", r"(?i)Portfolio\s+Turnover\s*\(Times\)\s+(\d+\.\d+)", 1.0, False),
    ("pgim_india", r"(?i)Portfolio\s+Turnover\s*:\s*([0-9]+\.[0-9]+)", 1.0, False),
    ("sbi", r"(?i)Equity\s+Turnover\s*:\s*(\d+\.\d+)", 1.0, False),
    ("sundaram", r"(?i)Turnover\s+Ratio\s+(\d+(?:\.\d+)?)\b", 0.01, False),
    ("union", r"(?is)Turnover\s+Ratio[^a-zA-Z%]*?(?:\d+\.\d+\s*%?\s*){0,3}(\d+\.\d+)\s*times", 1.0, False),
    ("uti", r"(?i)Portfolio\s+Turnover[^0-9\n]{0,30}(\d+\.\d+)", 1.0, False),
    ("whiteoak_capital", r"(?i)Portfolio\s+Turn\s*Over\s+Ratio\s+(\d+(?:\.\d+)?)\s+Times", 1.0, False),
]
#: Company, heading, characters after its first place that are read, pattern there, scale.
WINDOW_RULES = [("bandhan", r"(?i)Portfolio\s+Turnover\s+Ratio", 400, r"\bEquity\s+(\d+\.\d+)\b", 1.0)]
#: Company, what is printed where there is no value: such a page has none, whatever else it holds.
NONE_RULES = [
    ("iti", r"(?i)Portfolio\s+Turnover\s+Ratio\s+(?:NA|-)\b"), ("lic", r"(?i)Annual\s+(?:Equity\s+)?Portfolio\s+Turnover\s+Ratio\s*:\s*NA\b"),
    ("nippon", r"(?i)Portfolio\s+Turnover\s*\(Times\)\s*--"),
]
#: Fixed values. first, second: the label's words (second: how it begins, null for labels of one word). label_x: the label
#: starts left of it. edge: the side of boxes that is compared. band: how far the words' edges differ at most. gap, ahead: points
#: and words between them at most. y_low, y_high: the value's edge below the label's. x_kind: the value starts after the label's end, near its start (within x_high) or between x_low and x_high;
#: right of x_low and left of x_high always. pattern: of the value without the characters of strip at its end.
POSITION_COLUMNS = "company string, first string, second string, label_x double, edge string, band double, gap double, ahead int, y_low double, y_high double, x_kind string, x_low double, x_high double, strip string, pattern string, scale double, pick string"
POSITION_RULES = [
    ("hdfc", "Equity", "turnover", 200.0, "bottom", 3.0, None, 5, -5.0, 5.0, "after", None, None, "[%,;.]+$", r"^(\d+\.\d{1,3})$", 0.01, "nearest"),
    ("nippon", "Portfolio", "turnover", 250.0, "bottom", 3.0, None, 7, -5.0, 5.0, "after", None, None, "[,;.]+$", r"^(\d+\.\d{1,3})$", 1.0, "nearest"),
    ("mahindra_manulife", "Portfolio", "turnover", 200.0, "top", 4.0, None, 7, -4.0, 4.0, "after", None, None, "[,;.%]+$", r"^(\d+\.\d{1,3})$", 1.0, "nearest"),
    ("sbi", "Equity", "turnover", 200.0, "bottom", 2.0, None, None, -2.0, 2.0, "after", None, 200.0, "[,;.]+$", r"^(\d+\.\d{1,3})$", 1.0, "nearest"),
    ("uti", "Portfolio", "turnover", 1e9, "bottom", 3.0, 30.0, None, -3.0, 3.0, "after", None, None, "$", r"^(\d+\.\d{1,3})$", 1.0, "nearest"),
    ("invesco", "Portfolio", "turnover", 200.0, "top", 3.0, 30.0, 5, -3.0, 3.0, "after", None, 200.0, "$", r"^(\d+\.\d+)$", 1.0, "rightmost"),
    ("tata", "Portfolio", "turnover", 100.0, "top", 3.0, 30.0, 5, -2.0, 15.0, "between", 100.0, 175.0, "$", r"^(\d+(?:\.\d+)?)%$", 0.01, "first"),
    ("axis", "PORTFOLIOTURNOVER", None, 260.0, "top", 0.0, None, None, 5.0, 35.0, "near", None, 60.0, "$", r"^(\d+\.\d+)$", 1.0, "first"),
    ("dsp", "Portfolio", "turnover", 1e9, "bottom", 3.0, 30.0, None, 5.0, 50.0, "near", None, 25.0, "$", r"^(\d+\.\d+)$", 1.0, "highest"),
]


def _number(text: Column, pattern: str, scale: float, any_sign: bool = False) -> Column:
    value = F.regexp_extract(text, pattern, 1).try_cast("double") * scale
    return value if any_sign else F.when(value > 0, value)


def _by_company(rules: dict[str, Column]) -> Column:
    """One expression in which a page meets the rules of its own company only."""
    return reduce(lambda chain, r: chain.when(F.col("company") == r[0], r[1]), list(rules.items())[1:], F.when(F.col("company") == next(iter(rules)), next(iter(rules.values()))))


def turnover_by_text(pages: DataFrame) -> DataFrame:
    """company, page_no, ptr (a fraction), outcome (value, none or missing) of pages (company, page_no, page_text) of the companies with rules."""
    text, values = F.col("page_text"), {}
    for company, pattern, scale, any_sign in TEXT_RULES:
        values.setdefault(company, []).append((pattern, scale, any_sign))
    first = {c: reduce(lambda chain, r: chain.when(text.rlike(r[0]), _number(text, *r)), rules[1:], F.when(text.rlike(rules[0][0]), _number(text, *rules[0]))) for c, rules in values.items()}
    for company, heading, many, pattern, scale in WINDOW_RULES:
        after = F.array_join(F.slice(F.split(text, heading, 2), 2, 1), "")
        first[company] = _number(F.substring(after, 1, many), pattern, scale)
    none = _by_company({c: text.rlike(p) for c, p in NONE_RULES})
    found = pages.filter(F.col("company").isin(*first)).select("company", "page_no", _by_company(first).alias("value"), F.coalesce(none, F.lit(False)).alias("is_none"))
    outcome = F.when(F.col("is_none"), "none").when(F.col("value").isNotNull(), "value").otherwise("missing")
    return found.select("company", "page_no", F.when(~F.col("is_none"), F.col("value")).alias("ptr"), outcome.alias("outcome"))


def _bands(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(F.floor(low / BAND).cast("long"), F.floor(high / BAND).cast("long")))


def turnover_by_position(boxes: DataFrame, rules: list[tuple] = POSITION_RULES, limit: float | None = None) -> DataFrame:
    """company, page_no, ptr of the pages whose word boxes (company, page_no, word_no, text, x0, x1, top, bottom) hold a label and its value.

    Of several labels with a value the first word counts, of several values the rule's pick: the nearest, rightmost, highest or first.
    """
    rule = boxes.sparkSession.createDataFrame([(k, *r) for k, r in enumerate(rules)], f"rule int, {POSITION_COLUMNS}")  # one row for each company
    page = ["company", "page_no", "rule"]
    words = boxes.join(F.broadcast(rule), "company").withColumn("y", F.when(F.col("edge") == "top", F.col("top")).otherwise(F.col("bottom"))).filter("y is not null and x0 is not null")
    heads = words.filter((F.col("text") == F.col("first")) & (F.col("x0") < F.col("label_x")))
    pairs = heads.filter("second is not null").withColumn("line", _bands(F.col("y") - F.col("band"), F.col("y") + F.col("band")))
    seconds = words.filter(F.lower("text").startswith(F.col("second"))).select(*page, F.floor(F.col("y") / BAND).alias("line"), *[F.col(c).alias(f"{c}_2") for c in ("word_no", "x0", "x1", "y")])
    beside = (F.abs(F.col("y_2") - F.col("y")) <= F.col("band")) & (F.col("x0_2") > F.col("x1")) & (F.col("gap").isNull() | (F.col("x0_2") < F.col("x1") + F.col("gap"))) & (F.col("ahead").isNull() | F.col("word_no_2").between(F.col("word_no") + 1, F.col("word_no") + F.col("ahead")))
    label = [*page, "word_no", "x0", "y", "y_low", "y_high", "x_kind", "x_low", "x_high", "strip", "pattern", "scale", "pick"]
    two = pairs.join(seconds, [*page, "line"]).filter(beside).groupBy(*label).agg(F.min(F.struct("word_no_2", "x1_2"))["x1_2"].alias("end"))
    labels = two.unionByName(heads.filter("second is null").select(*label, F.col("x1").alias("end")))
    around = labels.withColumn("line", _bands(F.col("y") + F.col("y_low"), F.col("y") + F.col("y_high")))
    numbers = words.withColumn("raw", F.expr("regexp_extract(regexp_replace(text, strip, ''), pattern, 1)")).filter("raw <> ''")
    numbers = numbers.select(*page, F.floor(F.col("y") / BAND).alias("line"), F.col("raw"), *[F.col(c).alias(f"{c}_v") for c in ("word_no", "x0", "y")])
    place = F.when(F.col("x_kind") == "after", F.col("x0_v") > F.col("end")).when(F.col("x_kind") == "near", F.abs(F.col("x0_v") - F.col("x0")) <= F.col("x_high")).otherwise(F.lit(True))
    bounded = (F.col("x_kind") == "near") | ((F.col("x_low").isNull() | (F.col("x0_v") > F.col("x_low"))) & (F.col("x_high").isNull() | (F.col("x0_v") < F.col("x_high"))))
    met = around.join(numbers, [*page, "line"]).filter((F.col("y_v") - F.col("y")).between(F.col("y_low"), F.col("y_high")) & place & bounded)
    value = F.col("raw").try_cast("double")
    order = F.when(F.col("pick") == "nearest", F.col("x0_v")).when(F.col("pick") == "rightmost", -F.col("x0_v")).when(F.col("pick") == "highest", F.col("y_v")).otherwise(F.lit(0.0))
    by_page = Window.partitionBy("company", "page_no").orderBy("word_no", order, "word_no_v")
    best = met.filter(value > 0).withColumn("_n", F.row_number().over(by_page)).filter("_n = 1").select("company", "page_no", (value * F.col("scale")).alias("ptr"))
    return best if limit is None else best.filter(F.col("ptr") < limit)


def turnover(pages: DataFrame, boxes: DataFrame) -> DataFrame:
    """company, page_no, ptr, source: by text, and by position on the pages of which no text rule decides."""
    text, place = turnover_by_text(pages), turnover_by_position(boxes).withColumnRenamed("ptr", "placed")
    both = text.join(place, ["company", "page_no"], "full")
    ptr = F.when(F.coalesce("outcome", F.lit("missing")) == "missing", F.col("placed")).otherwise(F.col("ptr"))
    return both.select("company", "page_no", ptr.alias("ptr"), F.when(F.col("outcome") == "value", "text").otherwise("position").alias("source")).filter("ptr is not null")

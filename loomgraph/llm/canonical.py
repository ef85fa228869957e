"""Mapping free-entered values to a canonical list (problem 3).

Values are deduplicated, normalised, and looked up in an inverted index of the list's character n-grams, by those
n-grams alone without which the threshold cannot be reached. Candidates are scored by the cosine of n-gram vectors
weighted by rarity in the list, and are accepted above a threshold and by a margin over the next entry. A check by the letter (one slip of the pen at most, same number for genes) follows, as
entries that share most of their words are different entries.
"""

from __future__ import annotations

import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.operators.skew import HEAVY_PARTS, lookup_join
from loomgraph.session import cut

#: A candidate's least cosine, and its least lead in score over the next entry. One slip in a symbol of five signs
#: leaves a cosine of about 0.42, in a longer name more; what shares less is no candidate.
THRESHOLD = 0.4
MARGIN = 0.02

#: Fixed words around a name that do not belong to it, by kind. They are those of clinical notes and suit lists of that kind.
BEFORE = {
    "condition": ("known", "suspected", "probable", "possible", "hx of", "history of", "pt with", "patient with", "h/o", "s/p"),
    "drug": ("oral", "inj", "iv", "po", "tab", "cap", "injection", "tablet", "capsule", "topical"),
    "gene": ("variant in", "variants in", "mutation in", "gene", "the"),
}
AFTER = {
    "condition": ("severe", "mild", "moderate", "nos", "unspecified", "chronic", "acute"),
    "drug": ("tab", "tabs", "tablet", "cap", "caps", "capsule", "inj", "oral", "generic", "calcium", "sodium", "hydrochloride", "hcl"),
    "gene": ("gene", "mutation", "variant", "variants", "mutations", "genotype"),
}
_DOSE = re.compile(r"\s*\b[0-9]+(?:[.,][0-9]+)?\s*(?:mg|mcg|µg|g|ml|iu)\b.*$")
_TIMES = re.compile(r"\s*\b(?:b\.?i\.?d|t\.?i\.?d|q\.?d|o\.?d)\b\.?\s*$")
#: Digits that are read for letters and the letters they are read for.
_LOOKS = str.maketrans("0124568", "OIZASGB")


def _plain(value: str) -> str:
    text = unicodedata.normalize("NFKC", value).casefold().replace("_", " ")
    text = "".join(c for c in text if unicodedata.category(c)[0] != "C" or c in "\t\n")
    return re.sub(r"\s+", " ", text).strip()


def _around(words: tuple[str, ...]) -> str:
    return "|".join(r"\.?\s+".join(map(re.escape, w.split(" "))) for w in words)


_LEADING = {k: re.compile(rf"^(?:{_around(w)})\.?(?:\s+|$)") for k, w in BEFORE.items()}
_TRAILING = {k: re.compile(rf"(?:^|[\s,;(–-]+)(?:{_around(w)})[.)\]]*$") for k, w in AFTER.items()}
_EDGES = re.compile(r"^[\s,;:()\[\].*®™-]+|[\s,;:()\[\]*®™-]+$")
_ASIDE = re.compile(r"(?<=\S)\s*\([^()]*\)$")


def _strip_words(text: str, kind: str) -> str:
    """Without a bracketed remark at the end and the words around a name."""
    text = _ASIDE.sub("", text)
    while True:
        was = text
        text = _TRAILING[kind].sub("", _LEADING[kind].sub("", _EDGES.sub("", text)))
        if text == was:
            return text


#: The same words run together, as blanks are slipped into genes' names.
_GENE_WORDS = re.compile(r"^(?:VARIANTS?IN|MUTATIONIN|GENE)(?=.{3})|(?<=.{3})(?:GENE|MUTATIONS?|VARIANTS?|GENOTYPE)$")


def normal_forms(value: str, kind: str) -> list[str]:
    """Forms under which a value is looked up; the first is the value itself without dirt.

    Conditions: words in order, an inverted ``B, A`` also as ``A B``; a point that ends a word marks an abbreviation
    and stays. Drugs: letters only, without dose, form and salt, also without an ending ``e``, ``s`` or ``um``.
    Genes: letters and digits only, upper case.
    """
    text = _strip_words(_plain(value), kind)
    if kind == "gene":
        form = _GENE_WORDS.sub("", "".join(c for c in text if c.isalnum()).upper())
        return [form] if form else []
    if kind == "drug":
        text = _strip_words(_TIMES.sub("", _DOSE.sub("", text)), kind)
        form = "".join(c for c in text if c.isalpha())
        forms = [form]
        forms += [form[: -len(end)] for end in ("e", "s", "um") if form.endswith(end) and len(form) > len(end) + 4]
        return [f for f in forms if f]
    text = text.replace("-", " ")
    texts = [text]
    if text.count(",") == 1:
        last, first = text.split(",")
        texts.append(f"{first.strip()} {last.strip()}")
    forms = []
    for t in texts:
        words = re.findall(r"[^\W_]+\.?", t)
        form = " ".join(w if w.endswith(".") and len(w) > 3 else w.rstrip(".") for w in words)
        forms.append(form)
    return [f for f in dict.fromkeys(forms) if f]


def entry_forms(name: str, kind: str) -> list[str]:
    return normal_forms(name, kind)[:1]


def _one_slip(a: str, b: str) -> bool:
    """Whether one letter inserted, left out, replaced or swapped with its neighbour turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (len(x) > 1 and x[1::-1] == y[:2] and x[2:] == y[2:])


def likeness(form: str, entry: str, kind: str, alias: bool) -> int:
    """2: the same but for dirt, abbreviation or look-alike signs; 1: but for one slip; 0: different."""
    if form == entry:
        return 2
    if alias and (kind != "drug" or len(entry) < 6):
        return 0
    if kind == "gene":
        number = re.search(r"[0-9]*$", entry).group()
        if number and not form.endswith(number):
            return 0
        stem, want = form[: len(form) - len(number)], entry[: len(entry) - len(number)]
        looks = stem.translate(_LOOKS)
        if looks == want:
            return 2
        return int(len(want) >= 3 and not stem[-1:].isdigit() and _one_slip(looks, want))
    if kind == "condition" and "." in form:
        words, wanted = form.split(" "), entry.split(" ")
        if len(words) == len(wanted) and all(w == v or (w.endswith(".") and len(w) > 3 and v.startswith(w[:-1])) for w, v in zip(words, wanted)):
            return 2
        form = form.replace(".", "")
    if form == entry:
        return 2
    return int(len(entry) >= 6 and _one_slip(form, entry))


def grams(text: Column) -> Column:
    """Distinct 2- and 3-grams of ``^text$`` (of its letters alone, if it has spaces)."""
    t = F.concat(F.lit("^"), text, F.lit("$"))
    pair = lambda n: F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substring(t, i, F.lit(n)))
    return F.array_distinct(F.concat(pair(2), F.when(F.length(t) >= 3, pair(3)).otherwise(F.array().cast("array<string>"))))


def _forms(values: Column, kinds: Column) -> Column:
    @F.pandas_udf("array<string>")
    def run(v: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([normal_forms(a, b) for a, b in zip(v, k)], dtype=object)

    return run(values, kinds)


def _likeness(form: Column, entry: Column, kind: Column, alias: Column) -> Column:
    @F.pandas_udf("int")
    def run(f: pd.Series, e: pd.Series, k: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([likeness(*x) for x in zip(f, e, k, a)], dtype="int32")

    return run(form, entry, kind, alias)


def _suffix(of: list[str], measure: Column, bound: Column) -> Column:
    """Whether a gram is among the commonest ones of its text that together stay below ``bound``."""
    common_first = Window.partitionBy(*of).orderBy(F.col("df").desc(), F.col("gram").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(measure).over(common_first) < bound


def match_values(values: DataFrame, terms: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(kind, value) -> kind, value, term_id, score for values that have an entry; others are left out.

    ``values`` holds distinct pairs. Names of the list are its terms and aliases; of entries that are alike in form
    (repeated rows) the smallest term_id stands. A value whose two best entries are closer than ``margin`` has none.

    Only pairs that can reach ``threshold`` meet, by an exact bound. With D the squared weights of the shared grams, e
    the length of the entry, n the grams of the form, s the shared ones and r the weight of a gram that the list
    lacks, the cosine is D / (e sqrt(D + (n - s) r^2 / 2)). From it follow D >= t^2 e^2 and, as D <= e^2,
    D + c s >= c n with c = t^2 r^2 / (2 - 2 t^2). So the rarest gram that both share lies neither among the commonest
    grams of the entry with less than t^2 e^2 in all, nor among those of the form with less than c n in all (each
    counting c more). The index holds, and is asked for, the other grams alone.
    """
    named = terms.where(F.col("kind").isin("gene", "condition", "drug")).select(
        "term_id",
        "kind",
        F.explode(
            F.concat(
                F.array(F.struct(F.col("term").alias("name"), F.lit(False).alias("alias"))),
                F.coalesce(F.transform("aliases", lambda a: F.struct(a.alias("name"), F.lit(True).alias("alias"))), F.array().cast("array<struct<name:string,alias:boolean>>")),
            )
        ).alias("n"),
    ).where(F.col("n.name").isNotNull())
    entries = named.withColumn("entry", _forms(F.col("n.name"), F.col("kind"))[0]).where(F.col("entry").isNotNull())
    entries = cut(entries.groupBy("kind", "entry").agg(F.min(F.struct(F.col("n.alias").alias("alias"), "term_id")).alias("m")).select("kind", "entry", "m.alias", "m.term_id"))
    rare = math.log(1 + entries.count())  # the weight of an n-gram that the list lacks
    least = threshold * threshold
    extra = least * rare * rare / (2 - 2 * least)

    # n-grams go by a hash of 64 bits
    codes = lambda c: F.transform(grams(c), lambda g: F.xxhash64(g))
    postings = entries.select("kind", "entry", F.explode(codes(F.col("entry"))).alias("gram"))
    df = postings.groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("df"))
    square = F.pow(F.log(1 + F.lit(math.expm1(rare)) / F.col("df")), 2)
    weights = cut(df.withColumn("w2", square))
    index = postings.join(weights, ["kind", "gram"])
    vectors = index.groupBy("kind", "entry").agg(F.sum("w2").alias("e2"), F.collect_list(F.struct("gram", "w2")).alias("grams"))
    vectors = cut(entries.join(vectors, ["kind", "entry"]))
    of_entry = index.join(vectors.select("kind", "entry", "e2"), ["kind", "entry"])
    kept = of_entry.withColumn("cut", _suffix(["kind", "entry"], F.col("w2"), F.col("e2") * (least * (1 - 1e-9)))).where(~F.col("cut")).select("kind", "gram", "entry")

    # few bytes but much work: kept apart, as adaptive execution would put them together
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forms = cut(values.repartition(parts, "kind", "value").select("kind", "value", F.explode(_forms(F.col("value"), F.col("kind"))).alias("form")))
    key = F.when(F.col("kind") == "gene", F.translate("form", "0124568", "OIZASGB")).otherwise(F.regexp_replace("form", "[.]", ""))
    # a gene's number is looked up as it is, too: both readings share the vector of the form
    bag = F.when(F.col("kind") == "gene", F.array_union(codes(F.col("form")), codes(key))).otherwise(codes(key))
    bags = cut(forms.select("kind", "form").distinct().withColumn("bag", bag))
    asked = bags.select("kind", "form", F.size("bag").alias("n_grams"), F.explode("bag").alias("gram")).join(weights, ["kind", "gram"])
    asked = asked.withColumn("cut", _suffix(["kind", "form"], F.col("w2") + F.lit(extra), F.col("n_grams") * F.lit(extra * (1 - 1e-9)))).where(~F.col("cut"))
    met = asked.select("kind", "form", "gram").join(kept, ["kind", "gram"]).select("kind", "form", "entry").repartition(parts, "kind", "form").distinct()

    pairs = met.join(bags, ["kind", "form"]).join(vectors, ["kind", "entry"])
    start = F.struct(F.lit(0.0).alias("dot"), F.lit(0).alias("n"))
    step = lambda t, g: F.when(F.array_contains(F.col("bag"), g["gram"]), F.struct((t["dot"] + g["w2"]).alias("dot"), (t["n"] + 1).alias("n"))).otherwise(t)
    # exploding the one sum keeps the optimizer from computing it anew in each place where it is used
    summed = F.explode(F.array(F.aggregate("grams", start, step))).alias("both")
    scored = pairs.select("kind", "form", "entry", "alias", "term_id", "e2", F.size("bag").alias("n_grams"), summed)
    f2 = F.col("both.dot") + (F.col("n_grams") - F.col("both.n")) * F.lit(rare * rare * 0.5)
    scored = scored.withColumn("cosine", F.col("both.dot") / F.sqrt(F.col("e2") * f2)).where(F.col("cosine") >= threshold)
    judged = scored.withColumn("like", _likeness(F.col("form"), F.col("entry"), F.col("kind"), F.col("alias"))).where(F.col("like") > 0)
    judged = judged.select("kind", "form", "term_id", (F.col("like") + F.col("cosine")).alias("score"))
    best_form = forms.join(judged, ["kind", "form"]).groupBy("kind", "value", "term_id").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("kind", "value").orderBy(F.desc("score"), "term_id")  # at most the entries that one slip makes
    top = best_form.withColumn("next", F.lead("score").over(ranked)).withColumn("rank", F.row_number().over(ranked))
    sure = top.where((F.col("rank") == 1) & (F.col("next").isNull() | (F.col("score") - F.col("next") >= margin)))
    return sure.select("kind", "value", "term_id", "score")


def typed_values(mentions: DataFrame, extractions: DataFrame) -> DataFrame:
    """One row per non-blank value: src_field, kind, row_id, pos (from 0), value."""
    symbols = mentions.select(
        F.lit("gene_symbol").alias("src_field"), F.lit("gene").alias("kind"), "row_id", F.lit(0).alias("pos"), F.col("gene_symbol").alias("value")
    )
    conditions = mentions.select(
        F.lit("associated_conditions").alias("src_field"), F.lit("condition").alias("kind"), "row_id", F.posexplode("associated_conditions").alias("pos", "value")
    )
    drugs = extractions.select(F.lit("drugs").alias("src_field"), F.lit("drug").alias("kind"), "row_id", F.posexplode("drugs").alias("pos", "value"))
    return symbols.unionByName(conditions).unionByName(drugs).where(F.col("value").rlike(r"(?U)[^\s\p{Z}\p{C}]"))


def map_values(mentions: DataFrame, extractions: DataFrame, terms: DataFrame, parts: int = HEAVY_PARTS) -> DataFrame:
    """All non-blank values with their entry: src_field, row_id, pos, value, term_id (-1: none), exact.

    ``exact`` tells a value that is identical to a term of its kind. Null and blank values are left out, as are null
    arrays. Each distinct value is matched once; its rows get the result by a lookup that broadcasts values in more
    than 1/``parts`` of the rows. Without terms every value has -1.
    """
    rows = typed_values(mentions, extractions)
    counted = cut(rows.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")))
    own = terms.where(F.col("kind").isNotNull() & F.col("term").isNotNull()).groupBy("kind", F.col("term").alias("value")).agg(F.min("term_id").alias("own_id"))
    known = counted.join(own, ["kind", "value"], "left")
    matched = match_values(counted.join(own, ["kind", "value"], "left_anti").select("kind", "value"), terms)
    key = F.concat_ws("\x00", "kind", "value").alias("key")
    table = cut(
        known.join(matched, ["kind", "value"], "left").select(
            key, "n", F.coalesce("own_id", "term_id", F.lit(-1)).alias("term_id"), F.col("own_id").isNotNull().alias("exact")
        )
    )
    total = table.agg(F.sum("n")).first()[0] or 0
    heavy = table.where(F.col("n") >= max(2, -(-total // parts))).select("key")
    joined = lookup_join(rows.withColumn("key", key), table.drop("n"), "key", heavy)
    return joined.select("src_field", "row_id", "pos", "value", "term_id", "exact")

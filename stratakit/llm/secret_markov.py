"""Secrets in texts: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Everything on the way is a DataFrame expression. Two models give the chance of each character after
the one before; a long token whose log-likelihood ratio favours the random model is a span of its own. Both are
trained on labelled samples: values of the patterns and digests as random strings, words and the
identifiers that they make as ordinary ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds, as Java regular expressions.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
"""Tokens that the models judge."""
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
"""The characters, and the place before the first one."""
RUN, MARKS = 256, 64
MARGIN, MARGIN_PER_CHARACTER = 12.0, 1.2
"""Log-likelihood ratios, of a token and per character, from which it counts as random."""


@dataclass
class RandomnessModel:
    ratios: list[float]
    """Log-likelihood ratio of a character after another, at STATES * before + after."""


def _code(character: Column) -> Column:
    """Place in the alphabet, from 1; 0 if it is not in there."""
    return F.instr(F.lit(ALPHABET), character)


# ---- training ------------------------------------------------------------------------------------


def fit(df: DataFrame, text: str = "text", most_rows: int = 600, words_per_row: int = 40,
        seed: int = 5) -> RandomnessModel:
    """Models from about most_rows texts at most, chosen by a hash of the text; the rest is not looked at.
    Of each about words_per_row words at most are drawn from its whole length.

    Random strings: the values that the base patterns find, and per word SHA-2 digests in hex, base64 and capitals.
    Ordinary ones: words, numbers, words joined as identifiers are (``a_b``, ``aB``, ``a-b``, ``ab``), and rules
    of one repeated sign.
    What comes to the driver are counts of pairs of characters, at most twice STATES squared.
    """
    body = F.col(f"`{text}`")
    rows = df.where(body.isNotNull())
    total = rows.count()
    if not total:
        return RandomnessModel([0.0] * STATES**2)
    bucket = F.pmod(F.xxhash64(body, F.lit(seed)), F.lit(1 << 30))
    sample = rows.where(bucket < int((1 << 30) * min(1.0, most_rows / total))).select(body.alias("body"))
    values = F.concat(
        F.regexp_extract_all("body", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("body", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("body", F.lit(HEX), F.lit(0)),
    )
    plain = F.regexp_replace(F.regexp_replace("body", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    sample = sample.select(
        values.alias("values"), F.regexp_extract_all(plain, F.lit("[A-Za-z0-9]+"), F.lit(0)).alias("words")
    )
    digest = F.sha2("word", 256)
    drawn = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.pmod(F.xxhash64(F.get("words", i), i), F.lit(1 << 20)) * F.size("words") < words_per_row << 20,
    )
    words = sample.where(F.size("words") > 0).select("words", F.explode(drawn).alias("at"))
    words = words.select("words", "at", F.get("words", F.col("at")).alias("word"))
    later = F.coalesce(F.get("words", F.col("at") + 1), F.lit(""))
    capital = F.concat(F.upper(F.substring(later, 1, 1)), F.substring(later, 2, 1000))
    thrice = F.coalesce(F.get("words", F.col("at") + 2), F.lit(""))
    ordinary = words.select(
        F.lit(0).alias("random"),
        F.explode(
            F.array(
                "word", F.concat_ws("_", "word", later, thrice), F.concat_ws("-", "word", later),
                F.concat("word", capital), F.concat("word", later), F.concat_ws("/", "word", later, thrice),
                F.upper(F.concat_ws("_", "word", later)), *[F.repeat(F.lit(sign), 20) for sign in "+/_=-"],
            )
        ).alias("token"),
    )
    random = words.select(
        F.lit(1).alias("random"),
        F.explode(
            F.array(
                F.base64(F.unhex(digest)), F.substring(digest, 1, 40),
                F.substring(F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", "")), 1, 20),
                F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit("x"), "word"), 256))), "[^A-Za-z0-9]", ""),
            )
        ).alias("token"),
    )
    found = sample.select(F.lit(1).alias("random"), F.explode("values").alias("token"))
    tokens = ordinary.union(random).union(found).where("token <> ''")
    pairs = tokens.select(
        "random",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("token")),
                lambda i: F.struct(
                    F.when(i == 1, 0).otherwise(_code(F.substring("token", i - 1, F.lit(1)))).alias("before"),
                    _code(F.substring("token", i, F.lit(1))).alias("after"),
                ),
            )
        ).alias("pair"),
    )
    counts = pairs.groupBy("random", "pair.before", "pair.after").count().collect()
    return RandomnessModel(_ratios({(r[0], r[1], r[2]): r[3] for r in counts}))


def _ratios(counts: dict[tuple[int, int, int], int], prior: float = 0.5) -> list[float]:
    """Every transition with a small count added. Both models are told apart by character, not by length."""
    ratios = []
    for before in range(STATES):
        sums = [sum(counts.get((label, before, after), 0) + prior for after in range(STATES)) for label in (0, 1)]
        for after in range(STATES):
            chances = [(counts.get((label, before, after), 0) + prior) / sums[label] for label in (0, 1)]
            ratios.append(round(math.log(chances[1] / chances[0]), 6))
    return ratios


# ---- spans ---------------------------------------------------------------------------------------


def _running(items: Column, first: Column, add, give) -> Column:
    """``give(held, item)`` of every item of an array, where ``held`` is what ``add`` has made of the items before it.

    Results are gathered in runs of a few hundred, as an array that grows by one item is copied each time.
    """
    runs = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(RUN))

    def inner(held: Column, item: Column) -> Column:
        return F.struct(add(held["held"], item).alias("held"), F.concat(held["out"], F.array(give(held["held"], item))).alias("out"))

    nothing = F.filter(F.transform(F.slice(items, 1, 1), lambda x: give(first, x)), lambda _: F.lit(False))

    def outer(held: Column, run: Column) -> Column:
        begun = F.struct(held["held"].alias("held"), nothing.alias("out"))
        done = F.aggregate(F.slice(items, run + 1, RUN), begun, inner)
        # The run is taken apart once: a struct of its end and its items, appended to the runs.
        return F.transform(F.array(done), lambda d: F.struct(d["held"].alias("held"), F.concat(held["out"], F.array(d["out"])).alias("out")))[0]

    begun = F.struct(first.alias("held"), F.filter(F.array(nothing), lambda _: F.lit(False)).alias("out"))
    return F.aggregate(runs, begun, outer, lambda held: F.flatten(held["out"]))


def _gaps(text: Column, matches: Column, pattern: str) -> Column:
    """Of each match the characters between the match before and this one, and its own. The text is split once."""
    between = F.split(text, pattern, -1)
    lengths = F.transform(between, lambda x: F.length(x))
    sized = F.zip_with(lengths, matches, lambda gap, match: F.struct(gap.alias("gap"), F.length(match).alias("own")))
    nothing = F.array().cast("array<struct<gap:int,own:int>>")
    return F.when(F.size(matches) > 0, F.slice(sized, 1, F.size(matches))).otherwise(nothing)


def _places(gaps: Column, kind: str) -> Column:
    """Spans (start, kind number, end) of all matches, by adding up their gaps."""

    def after(at: Column, x: Column) -> Column:
        return at + x["gap"] + x["own"]

    def span(at: Column, x: Column) -> Column:
        return F.struct((at + x["gap"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), after(at, x).alias("end"))

    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return F.when(F.size(gaps) > 0, _running(gaps, F.lit(0).cast("long"), after, span)).otherwise(empty)


def log_ratio(token: Column, model: RandomnessModel) -> Column:
    """How much better the random model explains a token than the ordinary one; higher is more random.

    The token is split into its characters once, and each is seen beside the one before.
    """
    table = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<double>")
    codes = F.transform(F.filter(F.split(token, ""), lambda x: x != ""), _code)

    def ratio(before: Column, after: Column) -> Column:
        return F.when(after.isNotNull(), F.get(table, before * STATES + after)).otherwise(0.0)

    # The character before the first has code 0; the last one is followed by none.
    return F.aggregate(F.zip_with(F.concat(F.array(F.lit(0)), codes), codes, ratio), F.lit(0.0), lambda held, x: held + x)


def find(df: DataFrame, model: RandomnessModel, text: str = "text") -> DataFrame:
    """The rows with an array ``secrets`` of (start, kind, end), in order of start and kind, as a new last column.

    kind is a number in KINDS; start and end count code points, end is exclusive. Base spans are the leftmost
    non-overlapping ones of their kind. Tokens that the models find random are added where they meet no base
    span. Null and empty texts have an empty array. One pass over whole texts, without a shuffle.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    body = F.col("_body")
    rows = df.select(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_body")).withColumns(
        {
            "_assign": F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(0)),
            "_value": F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2)),
            "_access": F.regexp_extract_all(body, F.lit(ACCESS), F.lit(0)),
            "_hex": F.regexp_extract_all(body, F.lit(HEX), F.lit(0)),
            "_token": F.regexp_extract_all(body, F.lit(TOKEN), F.lit(0)),
        }
    )
    rows = rows.withColumns(
        {
            "_assign": _gaps(body, F.col("_assign"), ASSIGN),
            "_access": _gaps(body, F.col("_access"), ACCESS),
            "_hex": _gaps(body, F.col("_hex"), HEX),
        }
    )
    rows = rows.withColumns(
        {
            "_assign": F.filter(
                _places(F.col("_assign"), "assign"),
                lambda span, i: F.length(F.get(F.col("_value"), i)) >= 6,
            ),
            "_access": _places(F.col("_access"), "access"),
            "_hex": _places(F.col("_hex"), "hex"),
            "_judged": F.transform(
                "_token",
                lambda token: log_ratio(token, model) >= F.greatest(F.lit(MARGIN), MARGIN_PER_CHARACTER * F.length(token)),
            ),
        }
    )
    rows = rows.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    none = F.array().cast("array<struct<gap:int,own:int>>")
    rows = rows.withColumn("_gaps", F.when(F.exists("_judged", lambda x: x), _gaps(body, F.col("_token"), TOKEN)).otherwise(none))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    random = F.filter(_places(F.col("_gaps"), "markov"), lambda span, i: F.get(F.col("_judged"), i))
    rows = rows.withColumn("_all", F.when(F.size("_gaps") > 0, F.array_sort(F.concat("_base", random))).otherwise(empty))
    # In order of their starts, a random token meets a base span if one before it reaches over its start, or one after
    # it starts before its end.
    markov, none, far = KINDS.index("markov"), F.lit(0).cast("long"), F.lit(1 << 60)
    ends = _running(
        F.col("_all"), none, lambda held, x: F.when(x["kind"] < markov, F.greatest(held, x["end"])).otherwise(held),
        lambda held, x: held > x["start"],
    )
    starts = _running(
        F.reverse("_all"), far, lambda held, x: F.when(x["kind"] < markov, F.least(held, x["start"])).otherwise(held),
        lambda held, x: held < x["end"],
    )
    rows = rows.withColumns({"_over": F.when(F.size("_all") > 0, ends), "_under": F.when(F.size("_all") > 0, F.reverse(starts))})
    free = F.filter("_all", lambda x, i: (x["kind"] < markov) | ~(F.get("_over", i) | F.get("_under", i)))
    rows = rows.withColumn("secrets", F.when(F.size("_all") > 0, free).otherwise(F.col("_base")))
    kept = [F.col("_row").getField(c).alias(c) for c in df.columns if c.lower() != "secrets"]
    return rows.select(*kept, "secrets")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def redact(df: DataFrame, model: RandomnessModel, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every secret in the text replaced by a mark; spans that touch or overlap become one mark."""
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_own")
    rows = find(df.select(own, F.col(f"`{text}`").alias("_text")), model, "_text")
    body = F.col("_text")

    # Each span with the end of all spans before it; a mark stands for those that begin behind that end.
    reach = _running(
        F.col("secrets"), F.lit(0).cast("long"), lambda held, x: F.greatest(held, x["end"]),
        lambda held, x: F.struct(held.alias("since"), x["start"].alias("start"), F.greatest(held, x["end"]).alias("end")),
    )
    rows = rows.withColumn("_reach", F.when(F.size("secrets") > 0, reach))
    marks = F.filter("_reach", lambda x, i: (i == 0) | (x["start"] > x["since"]))
    rows = rows.withColumn("_marks", marks)

    def cut(text: Column, start: Column, end: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))

    def piece(own: Column) -> Column:
        """The text of a run of marks is cut out of the whole once, and taken apart from there."""
        begin = own[0]["since"]
        region = F.struct(own.alias("own"), cut(body, begin, F.element_at(own, -1)["start"]).alias("text"))

        def parts(r: Column) -> Column:
            at = r["own"][0]["since"]
            return F.array_join(F.transform(r["own"], lambda x: F.concat(cut(r["text"], x["since"] - at, x["start"] - at), F.lit(mark))), "")

        return F.transform(F.array(region), parts)[0]

    runs = F.transform(F.sequence(F.lit(0), F.size("_marks") - 1, F.lit(MARKS)), lambda r: F.slice("_marks", r + 1, MARKS))
    tail = F.substring(body, (F.element_at("_reach", -1)["end"] + 1).cast("int"), F.length(body))
    changed = F.when(F.size("secrets") > 0, F.concat(F.array_join(F.transform(runs, piece), ""), tail)).otherwise(body)
    return rows.select(*[(changed if c == text else F.col("_own").getField(c)).alias(c) for c in df.columns])

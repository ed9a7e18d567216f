"""Analyst reports over the mart and over the fact's yearly counts."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchvoice.functions import names, rules, scores
from branchvoice.operators.aggregates import with_total_row
from branchvoice.operators.ranking import number_rows, rank_rows, top_per_key
from branchvoice.operators.storage import stored

NAMES_IN_A_CELL = 10_000
TOTAL_LABEL = "TOTAL_TOUTES_BANQUES"


def _with_category(mart: DataFrame) -> DataFrame:
    return mart.withColumnsRenamed({"topic": "topic_name"}).withColumn(
        "topic_category", names.topic_category(F.col("topic_name"))
    )


FEELINGS = ("Positif", "Negatif", "Neutre")
STARS = (5, 4, 3, 2, 1)


def _feels(label: str) -> Column:
    return F.count_if(F.col("sentiment") == label)


def _measures() -> list[Column]:
    """Whole-number measures of a group: sums of them give every coarser group exactly."""
    star = F.floor(F.col("note") + 0.5)  # nearest whole star; unrated reviews have none
    return [
        F.count("*").alias("n"),
        F.sum((F.col("note") * 10).cast("long")).alias("tenths"),  # ratings have one decimal
        F.sum(F.length("avis").cast("long")).alias("characters"),
        *[_feels(label).alias(label) for label in FEELINGS],
        *[F.count_if(star == k).alias(f"star_{k}") for k in STARS],
    ]


def _note_mean(tenths: Column, n: Column) -> Column:
    return scores.ratio(tenths, n * 10, 2)


CUBE_KEYS = ["topic_name", "topic_category", "banque", "ville"]
#: Registers of a distinct-count sketch (2 to this power): estimates are off by 1.04 / sqrt(registers), 1.6 %, on average.
SKETCH_BITS = 12
#: Three times that: the band that an estimate is expected to keep.
SKETCH_BAND = 0.05


def topic_cube(mart: DataFrame, distinct: tuple[str, ...] = ()) -> DataFrame:
    """Measures per topic, bank and city: the only pass the topic reports make over the
    reviews. Written, because every report reads it several times.

    `distinct` columns get a mergeable sketch per cell, from which `distinct_counts` estimates the
    number of their values in any coarser group.
    """
    sketches = [F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{c}_sketch") for c in distinct]
    return stored(_with_category(mart).groupBy(*CUBE_KEYS).agg(*_measures(), *sketches), "cube")


def distinct_counts(cube: DataFrame, *keys: str) -> DataFrame:
    """Estimated number of distinct values of every sketched column per group: sketches are merged, no review is read."""
    sketched = [c.removesuffix("_sketch") for c in cube.columns if c.endswith("_sketch")]
    merged = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_distinct") for c in sketched]
    return cube.groupBy(*keys).agg(*merged)


def _roll_up(cube: DataFrame, *keys: str) -> DataFrame:
    measures = [c for c in cube.columns if c not in CUBE_KEYS and not c.endswith("_sketch")]
    return cube.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def report_bank_topic(mart: DataFrame, min_reviews: int = 1) -> DataFrame:
    """Bank x topic: count, rating, sentiments, length, satisfaction; groups below min_reviews are left out.

    The standard deviation comes from whole sums of tenths and of their squares.
    """
    squares = F.sum((F.col("note") * 10).cast("long") * (F.col("note") * 10).cast("long")).alias("squares")
    grouped = _with_category(mart).groupBy("banque", "topic_category", "topic_name").agg(*_measures(), squares)
    n = F.col("n")
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("n", "squares", "tenths")}
    variance = (whole["n"] * whole["squares"] - whole["tenths"] * whole["tenths"]).cast("double") / (n.cast("double") * (n - 1))
    spread = F.when(n > 1, F.floor(F.sqrt(variance) * 10 + 0.5).cast("double") / 100)
    return (
        grouped.filter(n >= min_reviews)
        .select(
            "banque",
            "topic_category",
            "topic_name",
            n.alias("nombre_avis"),
            _note_mean(F.col("tenths"), n).alias("note_moyenne"),
            spread.alias("note_ecart_type"),
            F.col("Positif").alias("sentiment_positif"),
            F.col("Negatif").alias("sentiment_negatif"),
            F.col("Neutre").alias("sentiment_neutre"),
            scores.ratio(F.col("characters"), n, 2).alias("longueur_moyenne_avis"),
            scores.pct(F.col("Positif"), n).alias("taux_satisfaction"),
            scores.pct(F.col("Negatif"), n).alias("taux_insatisfaction"),
        )
        .orderBy("banque", "topic_category", "topic_name")
    )


def _leader(cube: DataFrame, col: str) -> DataFrame:
    """Per topic: number of distinct values, and the most frequent one with its count;
    equal counts go to the first name."""
    counts = cube.groupBy("topic_name", col).agg(F.sum("n").alias("n"))
    return counts.groupBy("topic_name").agg(
        F.count(col).alias(f"nombre_{col}s"),
        F.min_by(col, F.struct(-F.col("n"), F.col(col))).alias(f"{col}_principale"),
        F.max("n").alias(f"{col}_principale_count"),
    )


def report_topic_distribution(mart: DataFrame) -> DataFrame:
    """Per topic: popularity, sentiments, star counts, leading bank and city, labels."""
    cube = topic_cube(mart)
    n = F.col("n")
    parts = {**{f"sentiment_{label.lower()}": label for label in FEELINGS}, **{f"note_{k}": f"star_{k}" for k in STARS}}
    topics = _roll_up(cube, "topic_name", "topic_category").select(
        "topic_name",
        "topic_category",
        n.alias("nombre_avis"),
        _note_mean(F.col("tenths"), n).alias("note_moyenne"),
        *[F.col(source).alias(f"{out}_count") for out, source in parts.items()],
        *[scores.pct(F.col(source), n).alias(f"{out}_pct") for out, source in parts.items()],
        scores.ratio(F.col("characters"), n, 0).alias("longueur_moyenne_avis"),
    )
    joined = topics.join(_leader(cube, "banque"), "topic_name").join(_leader(cube, "ville"), "topic_name")
    ranked = number_rows(joined, "rang_popularite", [F.desc("nombre_avis"), F.asc("topic_name")])
    # One row per topic is left for the window.
    rows, total = F.col("nombre_avis"), F.sum("nombre_avis").over(Window.partitionBy())
    top_feeling = F.greatest(*[F.col(f"sentiment_{label.lower()}_pct") for label in FEELINGS])
    dominant = F.when(top_feeling < rules.DOMINANT_SHARE, "Mixte")
    for label in FEELINGS:
        dominant = dominant.when(F.col(f"sentiment_{label.lower()}_pct") == top_feeling, label)
    return ranked.withColumn("pourcentage_total", scores.pct(rows, total)).withColumns(
        {
            "banque_principale_pct": scores.pct(F.col("banque_principale_count"), rows),
            "ville_principale_pct": scores.pct(F.col("ville_principale_count"), rows),
            "performance_level": scores.threshold_label(
                F.col("note_moyenne"), rules.PERFORMANCE_LEVELS, rules.LOW_PERFORMANCE
            ),
            "sentiment_dominant": dominant,
            "popularite_level": scores.threshold_label(
                F.col("pourcentage_total"), rules.POPULARITY_LEVELS, rules.LOW_POPULARITY
            ),
        }
    )


def name_lists(cube: DataFrame, key: str, col: str, out: str, most: int = NAMES_IN_A_CELL) -> DataFrame:
    """Sorted distinct names per key, joined by commas, in lists of at most `most`: key, place (0, 1 ...), out.

    Names that no rule knows pass through unchanged, so their number can grow with the data. They are
    numbered in their key, a large key over ranges, and no list holds more than its share.
    """
    pairs = stored(cube.select(key, col).distinct(), "names")
    places = rank_rows(pairs, key, [col], "_place").withColumn("place", F.floor((F.col("_place") - 1) / most))
    joined = F.expr(f"listagg(`{col}`, ', ') WITHIN GROUP (ORDER BY `{col}`)")
    return places.groupBy(key, "place").agg(joined.alias(out))


def with_names(report: DataFrame, lists: DataFrame, key: str, out: str) -> DataFrame:
    """The first list of each key in its row; further lists in rows of their own, with NULL measures."""
    first = report.join(lists.filter("place = 0").drop("place"), key)
    more = lists.filter("place > 0").select(
        *[F.col(c) if c in (key, out) else F.lit(None).cast(first.schema[c].dataType).alias(c) for c in first.columns]
    )
    return first.unionByName(more)


def report_topic_detail(mart: DataFrame, n: int = 2, most: int = NAMES_IN_A_CELL) -> DataFrame:
    """Per topic: totals, positive rate, banks, and the first n positive and negative texts.

    More than `most` banks go on in rows that hold topic and banks only.
    """
    cube = topic_cube(mart)
    totals = _roll_up(cube, "topic_name", "topic_category").select(
        "topic_name",
        "topic_category",
        F.col("n").alias("total_avis"),
        _note_mean(F.col("tenths"), F.col("n")).alias("note_moyenne"),
        *[F.col(label).alias(f"sentiment_{label.lower()}_count") for label in FEELINGS],
        scores.pct(F.col("Positif"), F.col("n")).alias("taux_positif"),
    )
    told = mart.filter(F.col("sentiment").isin("Positif", "Negatif")).select(
        F.col("topic").alias("topic_name"), "sentiment", "id", "avis"
    )
    firsts = top_per_key(told, ["topic_name", "sentiment"], ["id"], n)

    def texts(label: str) -> Column:
        # At most n texts per topic and sentiment are left.
        chosen = F.array_sort(F.collect_list(F.when(F.col("sentiment") == label, F.struct("id", "avis"))))
        joined = F.array_join(F.transform(chosen, lambda x: x["avis"]), " | ")
        return F.nullif(joined, F.lit(""))

    examples = firsts.groupBy("topic_name").agg(
        texts("Positif").alias("exemples_avis_positifs"), texts("Negatif").alias("exemples_avis_negatifs")
    )
    told = totals.join(examples, "topic_name", "left")
    banks = name_lists(cube, "topic_name", "banque", "banques_mentionnant", most)
    return with_names(told, banks, "topic_name", "banques_mentionnant")


def report_category_insights(mart: DataFrame, most: int = NAMES_IN_A_CELL) -> DataFrame:
    """Per category: totals, best and worst bank by mean rating, topics.

    More than `most` topics go on in rows that hold category and topics only.
    """
    cube = topic_cube(mart)
    n, tenths = F.col("n"), F.col("tenths")
    totals = _roll_up(cube, "topic_category").select(
        "topic_category",
        n.alias("nombre_total_avis"),
        _note_mean(tenths, n).alias("note_moyenne_categorie"),
        scores.pct(F.col("Positif"), n).alias("taux_positif_categorie"),
    )
    banks = _roll_up(cube, "topic_category", "banque").withColumn("m", _note_mean(tenths, n))
    extremes = banks.groupBy("topic_category").agg(
        F.min_by("banque", F.struct(-F.col("m"), F.col("banque"))).alias("meilleure_banque"),
        F.max("m").alias("note_meilleure_banque"),
        F.min_by("banque", F.struct("m", "banque")).alias("pire_banque"),
        F.min("m").alias("note_pire_banque"),
    )
    topics = name_lists(cube, "topic_category", "topic_name", "topics_inclus", most)
    joined = with_names(totals.join(extremes, "topic_category"), topics, "topic_category", "topics_inclus")
    return joined.withColumnRenamed("topic_category", "categorie")


def report_bank_year(counted: DataFrame, first: int = 2019, last: int = 2025) -> DataFrame:
    """Reviews per bank on a dense grid of years, with totals, share and rank.

    Every bank has a row for every year; one without reviews in the years has zeros, and NULL shares.

    `counted` has bank_name, review_year and fact_rows, the number of fact rows of a
    review: 1 on the strict fact, more where the specified joins multiply.
    """
    span = range(first, last + 1)
    years, rows = len(span), F.col("fact_rows")
    per_bank = counted.groupBy(F.col("bank_name").alias("banque")).agg(
        *[F.coalesce(F.sum(F.when(F.col("review_year") == y, rows)), F.lit(0)).cast("long").alias(f"n{y}") for y in span]
    )
    cells = F.array(*[F.struct(F.lit(y).alias("year"), F.col(f"n{y}").alias("nombre_avis")) for y in span])
    grid = per_bank.select("banque", F.inline(cells))
    # At most one row per bank and year: a window holds a handful of rows.
    bank = Window.partitionBy("banque")
    total = F.col("total_avis_banque")
    return grid.withColumn("total_avis_banque", F.sum("nombre_avis").over(bank)).withColumns(
        {
            "moyenne_annuelle_banque": scores.ratio(total, F.lit(years), 1),
            "pourcentage_annee": scores.pct(F.col("nombre_avis"), total),
            "rang_annee_banque": F.rank().over(bank.orderBy(F.desc("nombre_avis"))),
        }
    )


def report_bank_summary(bank_year: DataFrame) -> DataFrame:
    """Per bank: volume, best and worst year (earliest on ties), trend, regularity, rank.

    Trend is the sign of the regression slope over the years. A bank is 'Variable' when
    the standard deviation over its years exceeds their mean, 'Modérée' above half of it.
    """
    n, year = F.col("nombre_avis"), F.col("year")
    centred = F.sum(n * (year * 2))  # twice the sum of year * count
    per_bank = bank_year.groupBy("banque").agg(
        F.sum("nombre_avis").alias("total_avis_2019_2025"),
        F.first("moyenne_annuelle_banque").alias("moyenne_annuelle"),
        F.count_if(n > 0).alias("annees_actives"),
        F.max_by("year", F.struct(n, -year)).alias("meilleure_annee"),
        F.max("nombre_avis").alias("meilleur_score"),
        F.min_by("year", F.struct(n, year)).alias("pire_annee"),
        F.min("nombre_avis").alias("pire_score"),
        (F.max("nombre_avis") - F.min("nombre_avis")).alias("ecart_max_min"),
        (centred - F.sum("nombre_avis") * (F.min("year") + F.max("year"))).alias("_slope"),
        (F.sum(n.cast("decimal(18,0)") * n.cast("decimal(18,0)")) * F.count("*")).alias("_squares"),
        (F.sum(n).cast("decimal(19,0)") * F.sum(n).cast("decimal(19,0)")).alias("_square"),
    )
    # The deviation exceeds the mean when count * sum of squares exceeds twice the squared sum.
    slope, squares, square = F.col("_slope"), F.col("_squares"), F.col("_square")
    labelled = per_bank.withColumns(
        {
            "tendance_generale": F.when(slope > 0, "Croissante").when(slope < 0, "Décroissante").otherwise("Stable"),
            "regularite": F.when(squares > square * 2, "Variable").when(squares * 4 > square * 5, "Modérée").otherwise("Régulière"),
        }
    ).drop("_slope", "_squares", "_square")
    return number_rows(labelled, "rang_volume_total", [F.desc("total_avis_2019_2025"), F.asc("banque")])


def report_bank_year_pivot(bank_year: DataFrame, first: int = 2019, last: int = 2025) -> DataFrame:
    """Bank x year table with row total and mean and a closing row over all banks."""
    years = [str(y) for y in range(first, last + 1)]
    counts = F.col("nombre_avis")
    sums = [F.sum(F.when(F.col("year") == int(y), counts)).alias(y) for y in years]
    named = bank_year.select(F.col("banque").alias("index"), "year", "nombre_avis")
    total = reduce(add, [F.col(f"`{y}`") for y in years])
    closed = with_total_row(named, "index", TOTAL_LABEL, *sums).withColumn("TOTAL", total)
    means = closed.withColumn("MOYENNE", scores.ratio(F.col("TOTAL"), F.lit(len(years)), 1))
    return means.select("index", *[F.col(f"`{y}`").cast("double").alias(y) for y in [*years, "TOTAL"]], "MOYENNE")

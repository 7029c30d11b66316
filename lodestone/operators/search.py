"""Top-k page retrieval: the table job behind every search.

A page's score for a query is the sum of its impacts over the query's words. Impacts
are whole numbers, 1 at least, so sums do not depend on their order. ``top_pages`` is
exact and makes no row for a pair of a query and a page:

1. Pages with their words' counts, and queries with their words, are packed in blocks
   of bounded size. Every block of queries meets every block of pages in some task,
   which scores them all (``block_scores``) and keeps the k best of its pages. BM25's
   impacts are computed there, too, as they fill many more bytes than counts.
2. Queries whose words have long page lists take the pages first that are among the k
   best of some word. Their k-th score is a floor, and of the other pages only those
   that reach it leave a task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestone.functions.text import words
from lodestone.functions.urls import host, host_suffixes, path_extension
from lodestone.operators.block_scores import PAGE_COLUMNS, QUERY_COLUMNS, Added, Bm25, Impacts, best_of_blocks, bm25, by_words
from lodestone.operators.skew import FEW_SALTS, salted_join
from lodestone.session import discard, durable_small as durable

# Result counts, and the constants of the published BM25 formula.
RESULT_COUNT = 10
SECOND_RESULT_COUNT = 5
BM25_K1 = 1.2
BM25_B = 0.75

# A word on all of a billion pages still weighs some units.
IMPACT_UNIT = 10_000_000_000
MATCH_UNIT = 1 << 32
# Bounds of a block: pages and words on them, and scores of a block of queries on a block of pages.
BLOCK_PAGES = 2_048
SPLIT_ROWS = 1_048_576
SPLIT_PAIRS = 10_000_000
# Groups of page blocks, each read by a task for every block of queries: more only where there were too few tasks.
LEAST_GROUPS = 2
LEAST_TASKS = 32
# Postings that are shuffled at once, until there are so many rounds of looking words up and packing pages.
ROUND_ROWS = 2_097_152
ROUNDS = 16
# Words of queries that are shuffled at once, likewise; their rows are wider.
ROUND_TERMS = 524_288
SHORT_LISTS = 131_072
READ_ALL_FACTOR = 1
NO_RESULTS = "no results found"
NO_QUESTION = "invalid question"

SITE = r"(?i)(?:^|\s)site:(\S+)"
FILETYPE = r"(?i)(?:^|\s)filetype:(\S+)"
OPERATOR = r"(?i)(^|\s)(?:site|filetype):\S+"


@dataclass(frozen=True)
class PageIndex:
    """``documents(page_id, url, n_words)``, ``postings(token, page_id, tf, n_words)`` and ``frequency(token, df)``."""

    documents: DataFrame
    postings: DataFrame
    frequency: DataFrame


def build_index(documents: DataFrame) -> PageIndex:
    """Index ``(page_id, url, body)``.

    A page's words are counted within its row, so the page table is written without a
    shuffle; documents and postings are two readings of it.
    """
    words_of = documents.select("page_id", "url", F.sort_array(words(F.col("body"))).alias("_words"))
    runs = words_of.withColumn("n_words", F.size("_words").cast("long")).withColumn("_starts", _run_starts("_words"))
    counted = runs.select("page_id", "url", "n_words", _runs("_words", "_starts").alias("terms"))
    pages = durable(counted, "pages")
    postings = pages.select("page_id", "n_words", F.inline("terms"))
    frequency = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return PageIndex(pages.select("page_id", "url", "n_words"), postings, durable(frequency, "frequency"))


def _run_starts(array: str) -> Column:
    """Positions at which a sorted array's value changes."""
    positions = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(positions, lambda i: (i == 0) | (F.get(array, i) != F.get(array, i - 1)))


def _runs(array: str, starts: str) -> Column:
    """Distinct values of a sorted array with their counts."""
    return F.transform(
        starts,
        lambda start, i: F.struct(
            F.get(array, start).alias("token"),
            (F.coalesce(F.get(starts, i + 1), F.size(array)) - start).cast("long").alias("tf"),
        ),
    )


def effective_dorks(own: Column, shared: str | None) -> Column:
    """A question's own operators where it has any, else the shared ones."""
    return F.coalesce(F.when(own != "", own), F.lit(shared).cast("string"))


def search_text(question: Column, dorks: Column) -> Column:
    """The question, followed by the operators if there are any."""
    return F.when(F.coalesce(dorks, F.lit("")) == "", question).otherwise(F.concat_ws(" ", question, dorks))


def _scope(site: Column, filetype: Column) -> Column:
    return F.concat_ws("|", site, filetype)


def with_search_terms(queries: DataFrame) -> DataFrame:
    """Split ``query`` into a ``scope`` and its distinct words.

    All ``site:`` and ``filetype:`` operators must hold together. Sites that are
    suffixes of the longest one add nothing to it; any other mix matches no page and
    leaves ``scope`` null.
    """
    query = F.col("query")
    sites = F.array_distinct(F.transform(F.regexp_extract_all(query, F.lit(SITE), F.lit(1)), F.lower))
    types = F.array_distinct(F.transform(F.regexp_extract_all(query, F.lit(FILETYPE), F.lit(1)), F.lower))
    by_length = F.transform("_sites", lambda s: F.struct(F.length(s).alias("n"), s.alias("s")))
    longest = F.array_max(by_length)["s"]
    nested = F.forall("_sites", lambda s: (s == F.col("_site")) | F.endswith(F.col("_site"), F.concat(F.lit("."), s)))
    return (
        queries.withColumn("_sites", sites)
        .withColumn("_types", types)
        .withColumn("_site", F.when(F.size("_sites") == 0, "").otherwise(longest))
        .withColumn("_type", F.when(F.size("_types") == 0, "").otherwise(F.col("_types")[0]))
        .withColumn("scope", F.when((F.size("_types") <= 1) & nested, _scope(F.col("_site"), F.col("_type"))))
        .withColumn("terms", F.array_sort(F.array_distinct(words(F.regexp_replace(query, OPERATOR, "$1")))))
        .drop("_sites", "_types", "_site", "_type")
    )


def page_scopes(documents: DataFrame, scopes: DataFrame) -> DataFrame:
    """``(page_id, scope)`` for every wanted scope a page falls into.

    A page has one scope per label of its host and file type, so its row count is
    bounded by its URL, not by the number of queries.
    """
    url = F.col("url")
    sites = F.array_union(F.array(F.lit("")), host_suffixes(host(url)))
    types = F.array_distinct(F.array(F.lit(""), path_extension(url)))
    every = F.flatten(F.transform(sites, lambda s: F.transform(types, lambda t: _scope(s, t))))
    own = documents.select("page_id", F.explode(F.array_distinct(every)).alias("scope"))
    return salted_join(own, scopes, ["scope"], ["page_id"], "left_semi")


def _idf(df: Column, n_pages: Column) -> Column:
    return F.log(1 + (n_pages - df + 0.5) / (df + 0.5))


def bm25_impacts(index: PageIndex, postings: DataFrame) -> DataFrame:
    """Add ``impact`` to postings: BM25 weights in whole units, rounded per word, 1 at least.

    So no page that holds a word is lost, however common the word is.
    """
    corpus = index.documents.agg(F.count(F.lit(1)).alias("_n"), F.avg("n_words").alias("_avg"))
    weight = bm25(_idf(F.col("df"), F.col("_n")), F.col("tf"), F.col("n_words"), F.col("_avg"), BM25_K1, BM25_B)
    rows = postings.crossJoin(F.broadcast(corpus))
    impact = F.greatest(F.lit(1), F.round(weight * IMPACT_UNIT)).cast("long")
    return rows.withColumn("impact", impact).drop("_n", "_avg")


def match_impacts(index: PageIndex, postings: DataFrame) -> DataFrame:
    """Impacts that rank by matched distinct words, then by how often they occur."""
    return postings.withColumn("impact", F.lit(MATCH_UNIT) + F.col("tf"))


#: Adds ``impact`` to postings ``(page_id, tf, n_words, df)``.
Weigh = Callable[[PageIndex, DataFrame], DataFrame]


@dataclass(frozen=True)
class Ranking:
    """How tasks get impacts: a block's lists of counts, and what makes impacts of them."""

    counts: str
    impacts: Impacts


def _rankings(index: PageIndex, weighs: list[Weigh]) -> list[Ranking]:
    """BM25 and matches are weighed in tasks; blocks hold impacts of other weighings, ``impact_0``, ``impact_1``, ..."""
    average = index.documents.agg(F.avg("n_words")).first()[0] if bm25_impacts in weighs else None
    known = {bm25_impacts: Ranking("tf", Bm25(average, BM25_K1, BM25_B, IMPACT_UNIT)), match_impacts: Ranking("tf", Added(MATCH_UNIT))}
    return [known.get(weigh) or Ranking(f"impact_{r}", Added(0)) for r, weigh in enumerate(weighs)]


def _weighed(index: PageIndex, postings: DataFrame, weighs: list[Weigh]) -> DataFrame:
    """Add ``impact_0``, ``impact_1``, ... of several rankings."""
    for ranking, weigh in enumerate(weighs):
        postings = weigh(index, postings).withColumnRenamed("impact", f"impact_{ranking}")
    return postings


@dataclass(frozen=True)
class Prepared:
    """Queries and the pages that hold their words, ready for one or several ``rankings``.

    ``terms(query_id, words, weights, scopes, reach)`` and tables of page blocks; how many there are of
    them; and whether some blocks hold leaders.
    """

    terms: DataFrame
    n_queries: int
    n_long: int
    short_lists: int
    tables: list[DataFrame]
    n_blocks: int
    led: bool
    rankings: list[Ranking]

    @property
    def blocks(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.tables)


def _weighed_terms(asked: DataFrame, words: DataFrame) -> DataFrame:
    """``(query_id, words, weights, scopes, reach)``: words by number, their weights and scopes, and how many pages their lists hold.

    ``scopes`` has one entry if it is that of all words.
    """
    known = salted_join(asked, words, ["token"], ["query_id"], "inner", FEW_SALTS)
    terms = known.groupBy("query_id").agg(F.collect_list(F.struct("scope", "word", "weight")).alias("terms"), F.sum("df").alias("reach"))
    scopes = F.array_distinct("terms.scope")
    scopes = F.when(F.size(scopes) == 1, scopes).otherwise(F.col("terms.scope"))
    return terms.select("query_id", F.col("terms.word").alias("words"), F.col("terms.weight").alias("weights"), scopes.alias("scopes"), "reach")


def _page_blocks(postings: DataFrame, counts: list[str], places: DataFrame, leaders: DataFrame, block: Column, tasks: int) -> DataFrame:
    """Pages in blocks, leaders apart from the others; see ``block_scores`` for the columns of a block."""
    names = ["word", "n_words", *counts]
    none = {c: F.lit(None).cast("long").alias(c) for c in postings.columns if c != "page_id"}
    rows = (
        postings.select("page_id", *none, F.lit(None).cast("string").alias("scope"), F.lit(False).alias("lead"))
        .unionByName(places.select("page_id", *none.values(), "scope", F.lit(False).alias("lead")))
        .unionByName(leaders.select("page_id", *none.values(), F.lit(None).cast("string").alias("scope"), F.lit(True).alias("lead")))
    )
    dealt = rows.where("page_id is not null").withColumn("block", block)
    term = F.when(F.col("word").isNotNull(), F.struct(*names)).alias("term")
    terms = dealt.repartition(tasks, "block").select("block", "page_id", term, "scope", "lead")
    pages = terms.groupBy("block", "page_id").agg(
        F.collect_list("term").alias("terms"), F.collect_list("scope").alias("scopes"), F.bool_or("lead").alias("lead")
    )
    pages = pages.where((F.size("terms") > 0) & (F.size("scopes") > 0))
    packed = pages.groupBy("block", "lead").agg(F.collect_list(F.struct("page_id", "terms", "scopes")).alias("pages"))
    terms = F.flatten("pages.terms")
    flat = packed.select(
        "lead",
        F.col("pages.page_id").alias("page_ids"),
        F.transform("pages.terms", F.size).alias("page_lengths"),
        terms["word"].alias("page_words"),
        terms["n_words"].alias("page_sizes"),
        *(terms[c].alias(c) for c in counts),
        F.transform("pages.scopes", F.size).alias("page_places"),
        F.flatten("pages.scopes").alias("page_scopes"),
    )
    numbers = [c for name in PAGE_COLUMNS[:-1] for c in (counts if name == "page_counts" else [name])]
    return flat.mapInArrow(by_words(counts), f"lead boolean, {', '.join(f'{c} binary' for c in numbers)}, page_scopes array<string>")


def _if_used(what: str, ranking: Ranking, lists: Column, kind: str) -> Column:
    """``lists``, or an empty list that is sent to tasks in their place."""
    return lists if what in ranking.impacts.uses else F.array().cast(f"array<{kind}>")


def _meet(queries: DataFrame, n_queries: int, pages: DataFrame, n_blocks: int, k: int, ranking: Ranking) -> DataFrame:
    """The best ``k`` pages of each query ``(query_id, words, weights, scopes, floor)`` in every group of page blocks.

    Every block of queries meets every block of pages. Nothing is shuffled for that: a task
    reads one block of queries and a group of page blocks, and gives ``k`` rows a query. The
    number of groups does not grow with the pages, so these rows grow with the queries only.
    """
    n = max(1, -(-n_queries // max(1, SPLIT_PAIRS // BLOCK_PAGES)))
    groups = min(n_blocks, max(LEAST_GROUPS, -(-LEAST_TASKS // n)))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n)).cast("int")).repartition(n, "block")
    asking = dealt.groupBy("block").agg(F.collect_list(F.struct("query_id", "floor", "words", "weights", "scopes")).alias("queries"))
    asking = asking.select(
        "block",
        F.col("queries.query_id").alias("query_ids"),
        F.col("queries.floor").alias("floors"),
        F.transform("queries.words", F.size).alias("query_lengths"),
        F.flatten("queries.words").alias("query_words"),
        _if_used("weights", ranking, F.flatten("queries.weights"), "double").alias("query_weights"),
        F.transform("queries.scopes", F.size).alias("query_places"),
        F.flatten("queries.scopes").alias("query_scopes"),
    )
    blocks = pages.select(*(F.col(ranking.counts).alias(c) if c == "page_counts" else c for c in PAGE_COLUMNS))
    pairs = blocks.coalesce(groups).hint("shuffle_replicate_nl").crossJoin(asking)
    kind = queries.schema["query_id"].dataType.simpleString()
    return pairs.select("block", *QUERY_COLUMNS, *PAGE_COLUMNS).mapInArrow(best_of_blocks(k, ranking.impacts), f"query_id {kind}, page_id long, score long")


def _looked_up(postings: DataFrame, words: DataFrame) -> DataFrame:
    """Postings of the words that are asked for, by the word's number."""
    used = salted_join(postings, words, ["token"], ["page_id"], "inner", FEW_SALTS)
    return used.select("page_id", "word", "tf", "n_words", "df")


def _rounds(key: str, rounds: int, part: Callable[[Column], DataFrame], label: str) -> list[DataFrame | str]:
    """``part`` of every round's rows, as ``durable`` takes them: the shuffle files of one round at a time are on disk."""
    first, *more = [part(F.pmod(F.xxhash64(key), F.lit(rounds)) == r) for r in range(rounds)]
    return [first, label, *more]


def _prepared(queries: DataFrame, index: PageIndex, weighs: list[Weigh], k: int, short_lists: int) -> Prepared:
    """What the rankings of ``queries`` share: every posting is looked up and packed once for all.

    Both are done for some blocks of pages at a time, each time a statement of its own, so that shuffle files
    of one round are on disk. What a round has looked up goes when it is packed.
    """
    asked = queries.where(F.col("scope").isNotNull()).select("query_id", "scope", F.explode("terms").alias("token"))
    asked = durable(asked, "asked")
    rankings, n_pages = _rankings(index, weighs), index.documents.count()
    weighted = any("weights" in r.impacts.uses for r in rankings)
    weight = _idf(F.col("df"), F.lit(n_pages).cast("long")) if weighted else F.lit(0.0)
    words = asked.select("token").distinct().join(index.frequency, "token")
    words = durable(words.withColumn("word", F.monotonically_increasing_id()).withColumn("weight", weight), "words")
    rounds = min(-(-asked.count() // ROUND_TERMS) or 1, ROUNDS)
    terms = durable(*_rounds("query_id", rounds, lambda own: _weighed_terms(asked.where(own), words), "terms"))
    n_queries, n_long, n_postings = terms.count(), terms.where(F.col("reach") > short_lists).count(), words.agg(F.sum("df")).first()[0] or 0
    n_blocks = max(1, -(-n_pages // BLOCK_PAGES), -(-n_postings // SPLIT_ROWS))
    rounds = max(1, min(-(-n_postings // ROUND_ROWS), ROUNDS, n_blocks))
    block = F.pmod(F.xxhash64("page_id"), F.lit(n_blocks)).cast("int")
    own = [F.pmod(block, F.lit(rounds)) == r for r in range(rounds)]
    used = [durable(_looked_up(index.postings.where(some), words), "used") for some in own]
    leaders = _leaders(_weighed(index, reduce(DataFrame.unionByName, used), weighs), k if n_long else 0, n_pages, rounds)
    led, scopes = not leaders.isEmpty(), asked.select("scope").distinct()
    counts = sorted({r.counts for r in rankings})
    tables = []
    for some, postings in zip(own, used):
        places = page_scopes(index.documents.where(some), scopes)
        weighed = _weighed(index, postings, weighs) if counts != ["tf"] else postings
        packing = weighed.select("page_id", "word", "n_words", *counts)
        tables.append(durable(_page_blocks(packing, counts, places, leaders.where(some), block, -(-n_blocks // rounds)), "page-blocks"))
        discard(postings)
    discard(asked, words, leaders)
    return Prepared(terms, n_queries, n_long, short_lists, tables, n_blocks, led, rankings)


def _scored(asked: Prepared, k: int, number: int = 0) -> tuple[DataFrame, list[DataFrame]]:
    """Scores that hold the best ``k`` pages of each prepared query by one of the rankings, and all tables that they took."""
    terms, blocks, n_blocks, ranking = asked.terms, asked.blocks, asked.n_blocks, asked.rankings[number]
    no_floor = F.lit(0).cast("long").alias("floor")
    if not asked.led:
        scores = durable(_meet(terms.withColumn("floor", no_floor), asked.n_queries, blocks, n_blocks, k, ranking), "scores")
        return scores, [scores]
    long, short = (terms.where(F.col("reach") > asked.short_lists), terms.where(F.col("reach") <= asked.short_lists).withColumn("floor", no_floor))
    first = _first_scores(long, asked.n_long, blocks, n_blocks, k, ranking)
    known = _with_floors(long, first, k)
    others = _above_shares(known, asked.n_long, blocks.where("not lead"), n_blocks, k, ranking)
    if asked.n_long < asked.n_queries:
        others = others.unionByName(_meet(short, asked.n_queries - asked.n_long, blocks, n_blocks, k, ranking))
    others = durable(others, "scores")
    return first.unionByName(others), [first, known, others]


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    """The best ``k`` pages of each query, ranked from 1."""
    return (
        scores.withColumn("rank", F.row_number().over(_best()))
        .where(F.col("rank") <= k)
        .select("query_id", "page_id", "score", "rank")
    )


def top_pages(queries: DataFrame, index: PageIndex, weigh: Weigh, k: int, short_lists: int = SHORT_LISTS) -> DataFrame:
    """The best ``k`` pages of each query ``(query_id, scope, terms)``, ranked from 1.

    Ties go to the smaller page id.
    """
    scores, _ = _scored(_prepared(queries, index, [weigh], k, short_lists), k)
    return _ranked(scores, k)


def _best() -> Window:
    return Window.partitionBy("query_id").orderBy(F.desc("score"), "page_id")


def _leaders(impacts: DataFrame, k: int, n_pages: int, rounds: int) -> DataFrame:
    """Pages that are among some word's ``k`` best; none where they are so many that they would not save reading all."""
    named = impacts.where("page_id is not null")
    if not k:
        return named.select("page_id").limit(0)

    def best(own: Column) -> DataFrame:
        found = []
        for impact in (c for c in impacts.columns if c.startswith("impact_")):
            by_word = Window.partitionBy("word").orderBy(F.desc(impact), "page_id")
            some = named.where(own).select("page_id", "word", impact).withColumn("_r", F.row_number().over(by_word))
            found.append(some.where(F.col("_r") <= k).select("page_id"))
        return reduce(DataFrame.unionByName, found).distinct()

    some = durable(*_rounds("word", rounds, best, "leaders"))
    found = durable(some.distinct(), "leaders")
    discard(some)
    if READ_ALL_FACTOR * found.count() < n_pages:
        return found
    discard(found)
    return named.select("page_id").limit(0)


def _first_scores(terms: DataFrame, n_queries: int, blocks: DataFrame, n_blocks: int, k: int, ranking: Ranking) -> DataFrame:
    """The best ``k`` of the leaders for each query."""
    asking = terms.withColumn("floor", F.lit(0).cast("long"))
    return durable(_meet(asking, n_queries, blocks.where("lead"), n_blocks, k, ranking), "first-scores")


def _with_floors(terms: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Queries with the score that their other pages have to reach."""
    floor = first.withColumn("_r", F.row_number().over(_best())).where(F.col("_r") == k).select("query_id", F.col("score").alias("floor"))
    known = terms.join(floor, terms["query_id"].eqNullSafe(floor["query_id"]), "left")
    return durable(known.select(terms["query_id"], "words", "weights", "scopes", F.coalesce("floor", F.lit(0).cast("long")).alias("floor")), "floors")


def _above_shares(asking: DataFrame, n_queries: int, blocks: DataFrame, n_blocks: int, k: int, ranking: Ranking) -> DataFrame:
    """The best pages that reach their query's floor, of those that no word named.

    A page that only equals the floor can replace its page if its id is smaller.
    """
    return _meet(asking, n_queries, blocks, n_blocks, k, ranking)


def _keyed(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the ``query_id`` of their words in their scope, and the distinct queries."""
    words = F.concat_ws(" ", F.coalesce("scope", F.lit("none")), F.array_join("terms", " "))
    keyed = with_search_terms(questions).withColumn("query_id", F.unhex(F.sha2(words, 256)))
    distinct = keyed.select("query_id", "scope", "terms").groupBy("query_id").agg(
        F.any_value("scope").alias("scope"), F.any_value("terms").alias("terms")
    )
    return keyed.drop("scope", "terms"), distinct


def _hits(ranked: DataFrame, index: PageIndex, keys: list[str]) -> DataFrame:
    """``(keys, _hits)``: the URLs of ``ranked(keys, page_id, rank)`` in their order, and their table."""
    best = durable(ranked, "best")
    pages = index.documents.where(F.col("url").isNotNull()).join(best.select("page_id").distinct(), "page_id", "left_semi")
    found = salted_join(best, pages.select("page_id", "url"), ["page_id"], ["query_id"], "inner", FEW_SALTS)
    hits = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "url"))).alias("_hits"))
    hits = durable(hits.select(*keys, F.col("_hits.url").alias("_hits")), "ranked")
    discard(best)
    return hits


def _answered(questions: DataFrame, keyed: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``urls`` and ``error`` to ``keyed`` questions from ``hits``."""
    spread = [c for c in questions.columns if c != "urls"]
    joined = salted_join(keyed.drop("urls"), hits, keys, spread, salts=FEW_SALTS)
    none = F.array().cast("array<string>")
    return joined.withColumn("urls", F.coalesce("_hits", none)).withColumn(
        "error",
        F.when(F.col("query").isNull(), NO_QUESTION).when(F.size("urls") == 0, NO_RESULTS),
    ).drop("query_id", "_hits")


def search(questions: DataFrame, index: PageIndex, weigh: Weigh, k: int) -> DataFrame:
    """Add ``urls`` and ``error`` to rows with a ``query``.

    Rows that ask for the same words in the same scope are searched once. A row
    without results keeps an empty list and an error text.
    """
    keyed, distinct = _keyed(questions)
    asked = _prepared(distinct, index, [weigh], k, SHORT_LISTS)
    scores, tables = _scored(asked, k)
    discard(asked.terms, *asked.tables)
    hits = _hits(_ranked(scores, k).select("query_id", "page_id", "rank"), index, ["query_id"])
    discard(*tables)
    return _answered(questions, keyed, hits, ["query_id"])


def supplied_urls(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into rows that bring their own URLs and rows that need a search."""
    has = F.coalesce(F.size("urls") > 0, F.lit(False))
    return questions.where(has), questions.where(~has)


def prepare_queries(questions: DataFrame, dorks: str | None = None, honour_overrides: bool = True) -> DataFrame:
    """Effective operators and query text of every question.

    With ``honour_overrides`` off a question is only its text: its own operators and
    URLs are ignored.
    """
    rows = questions
    if not honour_overrides:
        rows = rows.withColumn("dorks", F.lit(None).cast("string")).withColumn("urls", F.lit(None).cast("array<string>"))
    rows = rows.withColumn("dorks", effective_dorks(F.col("dorks"), dorks))
    return rows.withColumn("query", search_text(F.col("question"), F.col("dorks")))


def retrieve(
    questions: DataFrame, index: PageIndex, k: int = RESULT_COUNT, dorks: str | None = None, honour_overrides: bool = True
) -> DataFrame:
    """Results of all questions ``(…, question, dorks, urls)`` in one table."""
    supplied, open_rows = supplied_urls(prepare_queries(questions, dorks, honour_overrides))
    searched = search(open_rows, index, bm25_impacts, k)
    return supplied.withColumn("error", F.lit(None).cast("string")).unionByName(searched)


def retrieve_two_engines(questions: DataFrame, index: PageIndex, k: int = SECOND_RESULT_COUNT) -> DataFrame:
    """Both rankings side by side; operators and supplied URLs play no part here.

    Both read the same page blocks, so words are looked up and pages packed once.
    """
    rows = questions.drop("dorks", "urls").withColumn("query", F.col("question"))
    keyed, distinct = _keyed(rows)
    engines = {"bm25": bm25_impacts, "matches": match_impacts}
    asked = _prepared(distinct, index, list(engines.values()), k, SHORT_LISTS)
    scores = [_scored(asked, k, r) for r in range(len(engines))]
    discard(asked.terms, *asked.tables)
    best = [_ranked(some, k).select("query_id", F.lit(e).alias("engine"), "page_id", "rank") for (some, _), e in zip(scores, engines)]
    hits = _hits(best[0].unionByName(best[1]), index, ["query_id", "engine"])
    discard(*(table for _, tables in scores for table in tables))
    both = keyed.withColumn("engine", F.explode(F.array(*map(F.lit, engines))))
    found = _answered(rows, both, hits, ["query_id", "engine"])
    return found.select(*(c for c in found.columns if c != "engine"), "engine")

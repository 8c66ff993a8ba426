"""The given star-schema tables read as matches, names, standings and scorers.

``FIXTURES.md`` lists the expressions.  Everything here is derived by Spark from the whole
tables, so the work of each query grows with them.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from standwise.operators import stats
from standwise.operators.keyed import keep_first
from standwise.operators.matches import (
    clean_matches,
    clean_scorers,
    clean_standings,
    finished,
    typed_matches,
)
from standwise.sources.staging import SMALLEST, stage

# Order in which copies of a match appear in the source.
SOURCE_ORDER = [
    "src_shipdate",
    "src_partkey",
    "src_suppkey",
    "src_price",
    "src_quantity",
    "src_discount",
    "src_tax",
    "src_flag",
    "src_status",
]

# The same as columns of an order line.
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


# Columns of the given tables.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables:
    """Readers of one folder of the given tables and the model tables built on them.

    The properties hold plans. Those named ``stored_`` write their rows to a staged table
    when they are first asked for, and so run a job; the others read nothing by themselves,
    but build on stored ones where they use a table several times.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(GIVEN[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def nations(self, prefix: str) -> DataFrame:
        """Nation key, name, region and both in one under prefixed names."""
        nation, region = self.read("nation"), self.read("region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return joined.select(
            F.col("n_nationkey").alias(f"{prefix}_key"),
            F.col("n_name").alias(f"{prefix}_name"),
            F.col("r_name").alias(f"{prefix}_region"),
            F.concat_ws(" ", "n_name", "r_name").alias(f"{prefix}_full"),
        )

    @cached_property
    def host_lines(self) -> DataFrame:
        """Order lines with the nation keys of customer (home) and supplier (away).

        Lines whose two nations are the same are no game.  Texts that depend on the order
        alone are made there, before the join repeats them per line.  Orders meet their
        customers and lines their suppliers first, so that the lines are shuffled by order
        only, unless suppliers are too many for a broadcast; nations are looked up after that.
        """
        orders = self.read("orders").select(
            "o_orderkey",
            "o_custkey",
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("match_date"),
            (F.col("o_orderkey") % 38 + 1).cast("string").alias("round"),
        )
        customer = self.read("customer").select("c_custkey", "c_nationkey")
        supplier = self.read("supplier").select("s_suppkey", "s_name", "s_nationkey")
        hosted = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        lines = self.read("lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        games = lines.join(hosted, F.col("l_orderkey") == F.col("o_orderkey")).filter(
            F.col("c_nationkey") != F.col("s_nationkey")
        )
        return games.drop("o_orderkey", "o_custkey", "c_custkey", "s_suppkey")

    @property
    def game_lines(self) -> DataFrame:
        """Order lines with the nation of customer (home) and supplier (away)."""
        return _named(self.host_lines, self.nations("home"), self.nations("away"))

    @cached_property
    def aliases(self) -> DataFrame:
        return (
            self.nations("n")
            .filter(F.col("n_key") < 20)
            .select(F.col("n_full").alias("raw_name"), F.col("n_name").alias("name"))
        )

    @cached_property
    def matches_raw(self) -> DataFrame:
        """All-text matches, with repeated ids, in the form a scraper hands over."""
        return _texts(self.game_lines)

    @cached_property
    def first(self) -> DataFrame:
        """One raw row per match, without the columns that tell its place in the source.

        It is the row that ``keep_first`` finds in ``matches_raw``; texts that are made of a
        line's own columns and names of nations are added to it afterwards, so that they are
        not shuffled.  Lines whose nations have no names are left out before.
        """
        home, away = self.nations("home"), self.nations("away")
        known = self.host_lines
        for names, nation, key in ((home, "c_nationkey", "home_key"), (away, "s_nationkey", "away_key")):
            known = known.join(F.broadcast(names.select(key)), F.col(nation) == F.col(key), "left_semi")
        lines = keep_first(known.withColumn("match_id", match_id()), ["match_id"], LINE_ORDER)
        # A key whose names come twice would repeat its matches.
        home, away = home.dropDuplicates(["home_key"]), away.dropDuplicates(["away_key"])
        return _texts(_named(lines, home, away)).drop(*SOURCE_ORDER)

    @cached_property
    def matches(self) -> DataFrame:
        return clean_matches(self.matches_raw, self.aliases, SOURCE_ORDER)

    @cached_property
    def stored_first(self) -> DataFrame:
        """One raw row per match, written once: the base of document rows and late scores."""
        return stage(self.first, SMALLEST)

    @cached_property
    def finished(self) -> DataFrame:
        return finished(self.matches)

    @cached_property
    def stored_matches(self) -> DataFrame:
        """The matches, written once for the queries that read them several times; read from
        the stored first rows where these stand already."""
        if "stored_first" in vars(self):
            return typed_matches(self.stored_first, self.aliases)
        return stage(self.matches)

    @cached_property
    def stored_finished(self) -> DataFrame:
        return finished(self.stored_matches)

    def join_once(self) -> None:
        """Write the joined lines, and the few names, for a query that starts from them twice."""
        self.host_lines = stage(self.host_lines, SMALLEST)
        # Spark knows the size of what is written, and sends a small table to every task.
        self.aliases = stage(self.aliases)

    def cards(self) -> DataFrame:
        """Yellow and red cards per home team, from the line numbers."""
        games = self.stored_matches.withColumn(
            "line", F.regexp_extract("match_id", r"(\d+)$", 1).cast("int")
        )
        return games.groupBy(F.col("home").alias("team")).agg(
            F.sum(F.col("line") % 3).alias("yellow"), F.sum(F.col("line") % 2).alias("red")
        )

    @cached_property
    def standings_raw(self) -> DataFrame:
        """All-text standings of the finished matches; two teams lack a position."""
        totals = stats.team_totals(self.stored_finished).select(
            "team",
            (F.col("total_wins") * 3 + F.col("total_ties")).alias("points"),
            F.col("total_games").alias("games"),
            F.col("total_wins").alias("wins"),
            F.col("total_ties").alias("ties"),
            F.col("total_losses").alias("losses"),
            F.col("total_goals_for").alias("goals_for"),
            F.col("total_goals_against").alias("goals_against"),
            (F.col("total_goals_for") - F.col("total_goals_against")).alias("goal_diff"),
        )
        # Team names come from the nation table, which has 25 rows at every scale.
        table_order = Window.orderBy(
            F.desc("points"), F.desc("goal_diff"), F.desc("goals_for"), F.asc("team")
        )
        listed = ~F.col("team").isin("NATION_5", "NATION_17")
        share = F.col("points") / (F.col("games") * 3) * 100
        texts = ["points", "games", "wins", "ties", "losses", "goals_for", "goals_against"]
        texts += ["goal_diff", "yellow", "red"]
        return (
            totals.join(self.cards(), "team", "left")
            .withColumn("place", F.row_number().over(table_order))
            .select(
                F.when(listed, F.col("place").cast("string")).alias("position"),
                "team",
                *[F.col(c).cast("string").alias(c) for c in texts],
                (F.rint(share * 10) / 10).cast("string").alias("points_pct"),
            )
        )

    @cached_property
    def standings(self) -> DataFrame:
        return clean_standings(self.standings_raw)

    @cached_property
    def stored_standings(self) -> DataFrame:
        """The standings, written once for the queries that use them several times."""
        return stage(self.standings)

    @cached_property
    def team_stats(self) -> DataFrame:
        return stats.team_stats(self.stored_finished, self.standings)

    @cached_property
    def recent_form(self) -> DataFrame:
        return stats.recent_form(self.stored_finished)

    @cached_property
    def round_goals(self) -> DataFrame:
        return stats.round_goals(self.finished)

    @cached_property
    def scorers(self) -> DataFrame:
        return clean_scorers(self.scorers_raw)

    @cached_property
    def scorers_raw(self) -> DataFrame:
        """One row per supplier with the goals of its lines."""
        home_goals, _ = line_goals()
        goals = (
            self.read("lineitem").groupBy("l_suppkey").agg(F.sum(home_goals).alias("goals"))
        )
        supplier = self.read("supplier").join(
            self.nations("away"), F.col("s_nationkey") == F.col("away_key")
        )
        return goals.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("s_name").alias("player"),
            F.col("goals").cast("string").alias("goals"),
            F.col("away_name").alias("club"),
        )


def _named(lines: DataFrame, home: DataFrame, away: DataFrame) -> DataFrame:
    """Lines with the names of their nations; the nation table has 25 rows at every scale."""
    hosts = lines.join(F.broadcast(home), F.col("c_nationkey") == F.col("home_key"))
    return hosts.join(F.broadcast(away), F.col("s_nationkey") == F.col("away_key"))


def _texts(lines: DataFrame) -> DataFrame:
    """Lines with their nations as all-text matches, with their place in the source."""
    played = F.col("l_linenumber") != 7
    home_goals, away_goals = line_goals()
    return lines.select(
        match_id().alias("match_id"),
        "round",
        "match_date",
        F.when(F.col("l_linenumber") % 4 == 0, "A def.").otherwise("16:00").alias("kickoff"),
        F.col("home_full").alias("home"),
        F.col("away_full").alias("away"),
        F.when(played, home_goals.cast("string")).alias("home_goals"),
        F.when(played, away_goals.cast("string")).alias("away_goals"),
        F.col("s_name").alias("venue"),
        F.col("home_name").alias("city"),
        F.col("home_region").alias("state"),
        *[F.col(line).alias(name) for line, name in zip(LINE_ORDER, SOURCE_ORDER)],
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
    )


def match_id() -> Column:
    return F.concat(
        F.lit("M"),
        F.col("l_orderkey").cast("string"),
        F.lit("-"),
        F.col("l_linenumber").cast("string"),
    )


def line_goals() -> tuple[Column, Column]:
    """Home and away goals of an order line."""
    return F.col("l_quantity").cast("bigint") % 5, F.col("l_partkey") % 4


def document_rows(t: Tables) -> DataFrame:
    """Matches as rows of seven long document tables, with all the flaws such rows have."""
    key, line = F.col("order_key"), F.col("line")
    seq = key * 8 + line
    played = F.concat_ws(" x ", F.concat_ws(" ", "home", "home_goals"), F.concat_ws(" ", "away_goals", "away"))
    unplayed = F.concat_ws(" x ", "home", "away")
    game = (
        F.when(key % 11 == 0, F.concat_ws(" vs ", "home", "away"))
        .when(key % 13 == 0, "")
        .when(key % 17 == 0, "None")
        .when(F.col("home_goals").isNull(), unplayed)
        .otherwise(played)
    )
    cells = [
        F.when((line == 3) & (key % 5 == 0), "Ref").otherwise(seq.cast("string")),
        F.when(line == 1, F.concat(F.lit("Round "), "round")).otherwise(""),
        F.concat("match_date", F.lit("\nSat")),
        F.when(line == 2, "None").otherwise(F.concat(F.lit(" "), "kickoff")),
        game,
        F.col("venue"),
        F.col("city"),
        F.col("state"),
    ]
    short = F.array(*cells[:5])
    return t.first.select(
        (key % 7).alias("doc_id"),
        seq.alias("seq"),
        F.when(line == 6, short).otherwise(F.array(*cells)).alias("cells"),
    )


def number_ids(matches: DataFrame) -> DataFrame:
    """Matches whose id is the digits of order and line."""
    digits = F.regexp_extract("match_id", r"(\d+)-", 1).cast("bigint") * 8 + F.regexp_extract(
        "match_id", r"-(\d+)", 1
    ).cast("bigint")
    return matches.withColumn("match_id", digits.cast("string"))


def score_blocks(t: Tables) -> DataFrame:
    """Late scores of every third order: zero-padded ids, two blocks each."""
    key = F.col("order_key")
    blocks = F.explode(
        F.array(
            F.struct(F.lit(1).alias("seq"), F.concat("line", F.lit(" x 0")).alias("text")),
            F.struct(
                F.lit(2).alias("seq"),
                F.concat(
                    F.lit("Final "), (key % 4).cast("string"), F.lit(" X "), "line", F.lit(" |")
                ).alias("text"),
            ),
            F.struct(F.lit(3).alias("seq"), F.lit("postponed").alias("text")),
        )
    )
    ids = F.lpad((key * 8 + F.col("line")).cast("string"), 14, "0")
    return (
        t.stored_first.filter(key % 3 == 0)
        .select(ids.alias("id_text"), blocks.alias("block"))
        .select("id_text", "block.*")
    )


def score_links(t: Tables) -> DataFrame:
    """The same ids as links, with the score in the text around them."""
    key = F.col("order_key")
    ids = F.lpad((key * 8 + F.col("line")).cast("string"), 14, "0")
    return t.stored_first.filter(key % 3 == 1).select(
        F.concat(F.lit("/games/league/"), ids, F.lit("?tab=1")).alias("href"),
        F.col("line").alias("seq"),
        F.concat((key % 6).cast("string"), F.lit("x"), "line").alias("text"),
    )


def score_texts(t: Tables) -> DataFrame:
    """Free text per match: its score, then the reverse fixture with the score turned."""
    here = F.concat_ws(" ", "home", "home_goals", F.lit("x"), "away_goals", "away")
    there = F.concat_ws(" ", F.lower("away"), "away_goals", F.lit("X"), "home_goals", "home")
    return t.stored_first.filter(F.col("home_goals").isNotNull()).select(
        (F.col("order_key") * 8 + F.col("line")).alias("page_id"),
        F.concat(here, F.lit(". Return: "), there).alias("text"),
    )

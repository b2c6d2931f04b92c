"""The engine's inputs (listings, postings, scans, links) bound to the test tables.

Each binding is a projection with plain joins over whole tables; ``oracle.py`` states
the same in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.dims import GRACE_DAYS, LARGE_BOARD_GRACE, PLATFORM_KEYS, STATE_NAMES
from vacantia.operators.prepare import prepare
from vacantia.session import fixed_table
from vacantia.sources import employers as employer_source

LST_AS_OF = "2001-08-01"
EVT_AS_OF = "2024-01-31"
TTL_AS_OF = "2026-11-21"

CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PLATFORMS = list(PLATFORM_KEYS)
EMPLOYERS = 100
CONFIGURED = 97
STATE_CODES = list(STATE_NAMES)[:20]

LEADS = [
    "", "Junior", "Associate", "Senior", "Information", "Cyber", "Physical", "Cloud", "Solutions",
    "Graduate",
]
PRODUCTS = [
    "Security", "Splunk", "SOC", "RMF", "MDR", "Firewall", "Forensics Lab", "AWS", "Threat",
    "Third Party Risk", "IT Audit", "Identity & Access", "SoC CPU", "Software", "Underwriting",
    "National Security", "Data Center",
]
NOUNS = [
    "Analyst", "Engineer", "Specialist", "Architect", "Officer", "Administrator", "Consultant",
    "Researcher", "Intern", "Developer", "Manager", "Solutions Engineer", "Sales Engineer",
]
LEVELS = [
    "", "I", "II", "III", "II / III", "- Summer 2027", "(Level 2 or 3)", "New Grad 2027",
    "Internship - Summer 2025", "(Associate or Mid-Level)", "- Azure", "Residency 2024", "- UK",
    "Tier 1-3", "- Costa Rica", "- New Mexico", "$18.50/hr", "- 24 hr Operations",
    "- London", "- Bengaluru", "(Mexico City)", "- Georgia", "- Hamburg (Hybrid)",
]
PLACES = [
    "Arlington, VA", "Arlington, Virginia", "Arlington VA", "Washington, D.C.", "Hamburg, NY",
    "Hamburg, New York", "Remote (US)", "Remote", "United States", "Remote (Europe)",
    "London, UK; Remote", "London, UK; Austin, TX", "CA (US)", "GA", "Irving Texas United States",
    "Remote, VA", "Remote - CA", "San Francisco, CA • New York, NY", "Sunnyvale, California - HQ",
    "San Juan, Puerto Rico, PR", "", "Toronto, Canada", "WA - Seattle - Office",
]
DEMANDS = [
    "Candidates bring 0 to 3 years of experience.", "You have 3 to 5 years in defence.",
    "BS and 4 years, or MS and 2, or PhD and 0.",
    "Grade 1: Bachelor's + 1 year. Grade 2: Bachelor's + 4 years.",
    "Join a firm with 30+ years of experience. Must be at least 18 years old.",
    "6 years preferred.", "2+ years of scripting.\n1 year of networking; 8 years ideally.",
    "This is an entry-level role, no prior experience.", "Open to recent graduates.",
    "3+ years of protocols, threats, and response.",
    "Bachelor's Degree with 4 years. Doctoral Degree with 1 year.", "Send us a letter.",
    "No experience required; 3 years a bonus.", "Requires five years in a SOC, a degree preferred.",
    "At least 21 years old and 6 years of networking.", "Ideally, 4 years of scripting.",
    "2 years of Linux, 5 years of Go preferred.", "4 years of C, Rust, or Go preferred.",
    "Over the past 25 years our company grew. 1 year of experience.", "A minimum of 60 months of experience.",
    "We require 3 years of hunting.", "Twelve months of hands-on experience with our tools.",
    "For 40 years, we have made locks; 2 years of scripting.", "Our firm has built locks for 30 years, and asks for 4 years.",
]
SECRETS = [
    "An active Secret clearance is required.", "No security clearance needed.",
    "U.S. citizenship required.", "Public trust.", "All welcome.",
]
RULES = [
    ("the", "the"), ("en", "en"), ("de la", "de la"), ("that the", "that the"), ("is", "is"),
    ("elle", "ellé"), ("three", "of the the"),
]


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


def board_key_of(company: Column, suffix: Column) -> Column:
    """Board key of the nth test employer: each part of its platform's key, numbered."""
    tests = [
        (
            company % len(PLATFORMS) == i,
            F.concat_ws("/", *[F.concat(F.lit(p), company.cast("string"), suffix) for p in parts]),
        )
        for i, parts in enumerate(PLATFORM_KEYS.values())
    ]
    return F.coalesce(*[F.when(test, key) for test, key in tests])


class Data:
    """The test tables of one folder, and the bindings over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- listings ---------------------------------------------------------------------

    def _lines(self, need: set[str]) -> DataFrame:
        """Per order the facts its lines give; only the joins asked for are made."""
        lines = self.table("lineitem")
        facts = []
        if "role" in need:
            parts = self.table("part").select("p_partkey", "p_name")
            lines = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
            facts.append(F.concat_ws(" ", F.min("p_name"), F.max("p_name")).alias("role"))
        if "places" in need:
            code = F.coalesce(
                F.get(F.array(*[F.lit(c) for c in STATE_CODES]), F.col("n_nationkey")), "n_name"
            )
            spots = (
                self.table("supplier")
                .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .select("s_suppkey", "n_name", "n_regionkey", code.alias("state"))
            )
            lines = lines.join(spots, lines["l_suppkey"] == spots["s_suppkey"])
            facts += [
                F.sort_array(F.collect_set("n_name")).alias("locations"),
                F.sort_array(F.collect_set("state")).alias("states"),
                F.max(F.col("n_regionkey") == 0).alias("remote"),
            ]
        return lines.groupBy("l_orderkey").agg(*facts)

    def listings(self, *need: str) -> DataFrame:
        """One listing per order. ``need`` names the parts wanted: role, places, clearance."""
        wanted = set(need)
        orders = self.table("orders")
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        as_of = F.lit(LST_AS_OF).cast("date")
        added = F.date_sub(as_of, (key % 181).cast("int") - 1)
        closed = F.col("o_orderstatus") == "F"
        left = F.date_add(added, (cust % 91).cast("int"))
        none = F.array().cast("array<string>")
        if wanted & {"role", "places"}:
            lines = self._lines(wanted)
            orders = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        if "clearance" in wanted:
            owners = self.table("customer").select("c_custkey", "c_acctbal")
            orders = orders.join(owners, orders["o_custkey"] == owners["c_custkey"])
        has_places, has_role = "places" in wanted, "role" in wanted
        places = F.coalesce("locations", none) if has_places else none
        return orders.select(
            key.cast("string").alias("id"),
            pick(["intern", "newgrad", "earlycareer"], key).alias("type"),
            F.concat(F.lit("co"), (cust % EMPLOYERS).cast("string")).alias("company"),
            (F.coalesce("role", F.lit("")) if has_role else F.lit("")).alias("role"),
            F.col("o_orderpriority").alias("category"),
            F.array_join(places, "; ").alias("location"),
            places.alias("locations"),
            (F.coalesce("states", none) if has_places else none).alias("states"),
            (F.coalesce("remote", F.lit(False)) if has_places else F.lit(False)).alias("remote"),
            (F.col("c_acctbal") < 0 if "clearance" in wanted else F.lit(False)).alias("clearance"),
            F.concat(F.lit("https://jobs.example.com/"), key.cast("string")).alias("url"),
            added.alias("date_added"),
            closed.alias("closed"),
            F.when(closed, F.least(as_of, left)).alias("closed_date"),
            F.when(key % 5 == 0, F.lit("community")).otherwise(F.lit("board")).alias("source"),
            F.when(key % 35 == 0, F.date_add(added, 30)).alias("reopened_date"),
        )

    def board(self, *need: str) -> DataFrame:
        return prepare(self.listings(*need), LST_AS_OF)

    # --- employers and postings ---------------------------------------------------------

    def employer_rows(self) -> DataFrame:
        """Landed boards: an employer per customer residue, five of them with two boards."""
        n = self.table("orders").select((F.col("o_custkey") % EMPLOYERS).alias("n")).distinct()
        second = F.when(F.col("n") < 5, F.array(F.lit(""), F.lit("b"))).otherwise(
            F.array(F.lit(""))
        )
        boards = n.where(F.col("n") < CONFIGURED).withColumn("suffix", F.explode(second))
        number, suffix = F.col("n").cast("string"), F.col("suffix")
        entries = F.filter(
            F.array(
                *[
                    F.struct(
                        F.lit(part).alias("k"),
                        F.concat(F.lit(part), number, suffix).alias("v"),
                    )
                    for part in dict.fromkeys(p for ps in PLATFORM_KEYS.values() for p in ps)
                ]
            ),
            lambda e: F.array_contains(
                F.split(pick(["+".join(p) for p in PLATFORM_KEYS.values()], F.col("n")), r"\+"),
                e["k"],
            ),
        )
        return boards.select(
            pick(PLATFORMS, F.col("n")).alias("platform"),
            F.concat(F.lit("co"), number).alias("name"),
            F.map_from_entries(entries).alias("key"),
            F.when(F.col("n") % 3 == 0, F.lit(True)).alias("security_company"),
            F.when(F.col("n") % 2 == 0, F.array(F.lit("blog.tionsh.example.net"))).alias(
                "apply_hosts"
            ),
            F.when(F.col("n") % 4 == 0, F.array(F.lit("Ring"))).alias("search_terms"),
        )

    def employers(self) -> DataFrame:
        return employer_source.with_board_key(self.employer_rows())

    def postings(self, *need: str) -> DataFrame:
        """Listings as postings of their employer's board."""
        n = F.substring("company", 3, 3).cast("int")
        odd = F.col("id").cast("long") % 2 == 1
        suffix = F.when((n < 5) & odd, F.lit("b")).otherwise(F.lit(""))
        return self.listings(*need).withColumns(
            {
                "platform": pick(PLATFORMS, n),
                "board_key": board_key_of(n, suffix),
                "title": F.col("role"),
            }
        )

    # --- titles and texts ---------------------------------------------------------------

    def titles(self) -> DataFrame:
        """One posting per part, worded from its name and the literal lists."""
        key, size = F.col("p_partkey"), F.col("p_size").cast("long")
        third, fourth = F.floor(key / 17), F.floor(key / 7)
        words = [pick(LEADS, size), pick(PRODUCTS, key), pick(NOUNS, third), pick(LEVELS, fourth + size)]
        title = F.trim(F.regexp_replace(F.concat_ws(" ", *words), " +", " "))
        # The rules cost far more than reading: narrow rows are dealt out by key before them.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        parts = self.table("part").select("p_partkey", "p_size", "p_name").repartition(tasks, "p_partkey")
        return parts.select(
            key.alias("posting_id"),
            F.when(key % 2 == 0, title).otherwise(F.concat_ws(" ", "p_name", title)).alias("title"),
            pick(PLACES, key + size).alias("location"),
            F.concat_ws("\n", "p_name", pick(DEMANDS, third + size)).alias("description"),
            (key % 4 == 0).alias("sec_co"),
        )

    def texts(self) -> DataFrame:
        """Documents with a sentence on experience and one on clearance appended."""
        key = F.col("doc_id")
        text = F.concat_ws("\n", F.col("text"), pick(DEMANDS, key), pick(SECRETS, key))
        return self.table("documents").select("doc_id", "source", text.alias("text"))

    def submissions(self) -> DataFrame:
        """Documents as issue forms; some unlabelled, some with markup or a heading twice."""
        key = F.col("doc_id")
        head = F.concat(F.lit("### Company\n"), F.col("source"), F.lit("\n### Title\n"))
        tail = pick(["", "\n<details>x</details>", "\n### Title\nother", "\n<!-- x -->", ""], key)
        return self.table("documents").select(
            key.alias("issue_id"),
            F.col("source").alias("company"),
            F.concat(F.lit("Security Intern "), key.cast("string")).alias("title"),
            F.lit("Remote").alias("location"),
            F.lit("https://jobs.example.com/").alias("url"),
            F.lit("Not sure").alias("category"),
            F.concat(head, F.col("text"), tail).alias("body"),
            F.when(key % 3 == 0, F.array(F.lit("valid")))
            .otherwise(F.array(F.lit("valid"), F.lit("approved")))
            .alias("labels"),
        )

    # --- links and shared views -----------------------------------------------------------

    def links(self) -> DataFrame:
        """Pages as apply links of the test employers' boards; some unsafe."""
        key = F.col("page_id")
        n = (key % EMPLOYERS).cast("int")
        url = (
            F.when(key % 13 == 0, F.replace(F.col("url"), F.lit("https://"), F.lit("ftp://")))
            .when(key % 17 == 0, F.concat(F.col("url"), F.lit(" x")))
            .when(key % 19 == 0, F.replace(F.col("url"), F.lit("/en/"), F.lit("\\en/")))
            .otherwise(F.col("url"))
        )
        return self.table("pages").select(
            key.cast("string").alias("posting_id"),
            pick(PLATFORMS, n).alias("platform"),
            board_key_of(n, F.lit("")).alias("board_key"),
            url.alias("url"),
        )

    def vendor_domains(self) -> DataFrame:
        rows = [
            (p, ("example.com", "example.org", "vendor.example")[i % 3], f"https://{p}.vendor.example")
            for i, p in enumerate(PLATFORMS)
        ]
        return fixed_table(self.spark, rows, "platform, domain, job_page")

    def shared_links(self) -> DataFrame:
        """Pages as links to a view of the board, with known and unknown values."""
        key = F.col("page_id")
        base = F.substring_index("url", "#", 1)
        sep = F.when(F.contains(base, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
        return self.table("pages").select(
            key.alias("view_id"),
            F.concat(
                base, sep,
                pick(["type=intern", "type=newgrad", "type=earlycareer", "type=staff"], key),
                pick(["&cat=1-urgent,5-low", "&cat=2-high,unknown", ""], key),
                pick(["&q=small+ring", "&q=red%20wid", "&q=C%23,c%2B%2B", "&q=co1", ""], key),
                pick(
                    ["&state=remote", "&state=AL", "&state=ZZ", "&state=CO", "", "", ""], key
                ),
                pick(["&days=7", "&days=30", "&days=9", "", "", ""], key),
                pick(["&noclear=1", ""], key),
                pick(["&closed=1", "", "", "", "", "", "", "", ""], key),
                pick(["&sort=company", "", "", "", "", "", "", "", "", "", ""], key),
                F.lit("#top"),
            ).alias("url"),
        )

    def known_slugs(self) -> Column:
        """Category slugs the data holds, as a scalar subquery."""
        from vacantia.functions.text import slug

        found = self.table("orders").select(slug(F.col("o_orderpriority")).alias("s")).distinct()
        return found.agg(F.sort_array(F.collect_set("s"))).scalar()

    def known_places(self) -> Column:
        """State codes the suppliers reach, as a scalar subquery."""
        code = F.coalesce(
            F.get(F.array(*[F.lit(c) for c in STATE_CODES]), F.col("n_nationkey")), "n_name"
        )
        reach = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        found = reach.select(code.alias("s")).distinct()
        return found.agg(F.sort_array(F.collect_set("s"))).scalar()

    # --- scans and probes -------------------------------------------------------------------

    def scans(self) -> DataFrame:
        """Events as sightings: a listing per user and kind, a board per ten users.

        A board's scan fails on some days; what it read then does not count.
        """
        board = F.col("user_id") % 10
        day = F.to_date("ts")
        return self.table("events").select(
            F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("listing_id"),
            F.concat(F.lit("b"), board.cast("string")).alias("board"),
            "event_id", "ts", day.alias("day"), "user_id", "event_type", "value",
            ((F.dayofmonth(day) + board) % 9 != 0).alias("scan_ok"),
            pick(["intern", "newgrad", "earlycareer"], F.col("user_id")).alias("type"),
        )

    def scan_days(self) -> DataFrame:
        return self.scans().where("scan_ok").select("board", "day").distinct()

    def grace(self) -> DataFrame:
        """Days of grace per board: the boards numbered 0 and 5 are the large ones."""
        rows = [(f"b{i}", LARGE_BOARD_GRACE if i % 5 == 0 else GRACE_DAYS) for i in range(10)]
        return fixed_table(self.spark, rows, "board, grace")

    def checks(self) -> DataFrame:
        """Events as link checks, one listing per user."""
        outcome = (
            F.when(F.col("event_type") == "error", F.lit("gone"))
            .when(F.col("event_type") == "signup", F.lit("soft_gone"))
            .otherwise(F.when(F.col("user_id") % 2 == 0, F.lit("ok")).otherwise(F.lit("gone")))
        )
        return self.table("events").select(
            F.col("user_id").cast("string").alias("listing_id"),
            F.col("ts").alias("probe_ts"),
            outcome.alias("outcome"),
        )

    def marks(self) -> DataFrame:
        """Clicks as applied marks on the order of the same number."""
        return self.table("events").where("event_type = 'click'").select(
            "user_id", F.col("event_id").cast("string").alias("listing_id")
        )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)

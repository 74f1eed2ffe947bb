"""Inputs for the registered queries, derived from the given tables.

``notes`` is ``documents`` with one sentence per row appended; the raw lookup tables come from
``conversations``, ``customer``, ``pages`` and ``part`` plus a few seed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from notemask.constants import STATE_ABBREVIATIONS
from notemask.operators.gazetteers import Gazetteers, Lexicon, build_gazetteers, literal_rows, sql_text, title_case
from notemask.functions.chars import ENDS, STARTS
from notemask.sources.readers import CITY_COLUMNS, EXTRA_CITY_COLUMNS

# Documents of these slots come once more, as notes without text and with an empty one.
NULL_SLOT, EMPTY_SLOT = 1, 2

# One sentence per slot; {d} stands for four digits taken from the document id.
TEMPLATES = [
    "No findings were noted in this visit.",
    "Nothing else was said.",
    "The visit was short.",
    "SSN 123-45-{d} is on file.",
    "Record 12345{d} was opened.",
    "Account 8765{d} was billed.",
    "Call 555-123-{d} before noon.",
    "Phone (555)123-{d}. Leave a message",
    "Fax +1 or 1-555-123-{d} please",
    "Reach us at (555)  123-{d} daily",
    "Card 1234567890{d}99 was declined",
    "Write to jane{d}@mail.example.org today",
    "See https://portal.example.com/{d} or http://www.clinic.org for details",
    "Visit www.health{d}.net online",
    "Host 10.0.255.1 and 1.2.3.4567 answered",
    "Patient lives at 123 Oak Terrace , West Orange, NJ, 07052",
    "Mail goes to 68 OAK ST., Lincoln , NE 68501-{d} now",
    "He moved to 45 west 2nd ave yesterday and to 9 walker lane today",
    "Her room is at 12 Mill Road, APT 4B in town",
    "Dallas Memorial Hospital and Lincoln , NE",
    "Seen by Sarah Lincoln Clinic staff near Dallas VA Center",
    "They visited Deer Island, Winston-Salem and DEER ISLAND last year",
    "Deer Island Wilson called and Virginia Wilson came from North Dakota",
    "The patient lives in New Jersey; and the Dr is from North Dakota",
    "Sent to PAddress , AL and New PAddress 07052 68501 or 99999",
    "Code 07052 was used, not an address; Lincoln , Nebraska then Lincoln 68501",
    "Seen by KLEIN , MIRANDA S. today",
    "Signed CLARK , JULIE APR 5 and JONES , MYNA At: noon",
    "Intern, Laura S and NURSE , LAURA CLARK took notes",
    "Calvin McKinskey , RN and PATRICIA S. WAKEFIELD , M.D. agreed",
    "Dr. Norwin met Mrs. Li; later norwin and LI left with Ms PersonName",
    "Sarah Fawcett Waters MD and Butler , Michael Henry and Clark , SANDY",
    "Michael Henry Butler\nPAddress was updated",
    "Sarah M. Klein and Julie Q Clark and O'Brien arrived",
    "Follow Mary-Ann, Sarah-Louise and klein-type notes for Juan De La Cruz",
    "Butler's note says Veteran's care isn't done , 'am sorry",
    "List:\r\n[a], [b],\tc , d\r\nEnd [x]",
    "Labels Asst Neuro MD and Neuro Smith Jones RN or May Green and Home Hill",
    "Patient left ' early",
    "Address McAllen, TX and Carolina PR or San Juan, Puerto Rico 00901.",
    "Code 07052-1234 was used and part 11111-22 fits; Lincoln , NE 68501-{d} too",
    "Physician, Sarah Klein took notes; PHYSICIAN, SARAH CLARK and Surgeon , Julie Clark left",
    "Deer Island first, later deer island again, deer island Wilson; Virginia Beach, then virginia again",
    "He lives in Newark, New Jersey now and in Lincoln, North Carolina then",
    "Mail to 68 Oak St., then to 68 oak st. again; KLEIN , MIRANDA and klein , miranda",
    "Calvin Clark DO and PATRICIA JONES, D.O. agreed",
    "Sarah \ufdd0 met \ufdd3Klein\ufdd1 at Deer Island\ufdd2 there",
    "Went to Lake Of The Pines and Bay Of The Four Winds, then lake of the pines",
]

SEED_NAMES = [
    "Sarah", "Miranda", "Klein", "Calvin", "Julie", "Clark", "Wilson", "Butler", "Michael", "Henry",
    "Tamsin", "O'Brien", "McAllen", "Mary-Ann", "sarah", "Patricia", "De La Cruz", "Jones", "May", None,
]
SEED_STATES = [
    "Alabama", "AL", "Nebraska", "NE", "NORTH DAKOTA", "ND", "New Jersey", "NJ", "Virginia", "VA",
    "Texas", "TX", "West Virginia", "WV", "Maryland", "MD", "Ohio", "OH", "virginia", "Washington", "WA",
]
SEED_ZIPS = ["07052", "68501", "00901", "07052", "11111"]
SEED_CITIES = [
    ("Lincoln", "NE", "Nebraska", "Lancaster", "Lincoln"),
    ("Lincoln", "AL", "Alabama", "Talladega", "Lincoln"),
    ("West Orange", "NJ", "New Jersey", "Essex", "West Orange"),
    ("Deer Island", "AL", "Alabama", "Baldwin", None),
    ("Winston-Salem", "NC", "North Carolina", "Forsyth", "Winston"),
    ("Dallas", "TX", "Texas", "Dallas", "Dallas"),
    ("Butler", "MD", "Maryland", "Baltimore", "Butler"),
    ("McAllen", "TX", "Texas", "Hidalgo", "McAllen"),
    ("Hill", "OH", "Ohio", "Ross", "Hill"),
    ("Cut Off", "LA", "Louisiana", "Lafourche", "Cut Off"),
    ("Virginia", "AL", "Alabama", "Cullman", "Virginia"),
    ("88", "TX", "Texas", "None", "88"),
    ("Toronto", "ON", "Ontario", "York", "Toronto"),
    ("Nowhere", "OH", None, None, None),
    ("Newark", "NJ", "New Jersey", "Essex", "Newark"),
    ("Lake Of The Pines", "CA", "California", "Nevada", "Pines"),
    ("Bay Of The Four Winds", "ME", "Maine", "Knox", "Winds"),
]
SEED_EXTRA_CITIES = [
    ("1", "PR", "Puerto Rico", "San Juan", "San Juan", "18.4", "-66.0"),
    ("2", "PR", "Puerto Rico", "Carolina", "Carolina", "18.4", "-66.0"),
    ("3", "OH", "Ohio", "Dallas", "Dallas", "40.0", "-82.0"),
    ("4", "PR", "Puerto Rico", "Mayagüez", "Mayagüez", "18.2", "-67.1"),
    ("5", "GU", "Guam", "Guam", "Guam", "13.4", "144.7"),
]
FOREIGN_CODES = ["ON", "QC", "BC"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index):
    """The ``index``-th of a short list of literals."""
    return F.element_at(F.expr(f"array({', '.join(map(sql_text, values))})"), (index + 1).cast("int"))


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with one sentence appended, and a few notes without text: (doc_id, text)."""
    slot = F.col("doc_id") % len(TEMPLATES)
    digits = F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0")
    sentence = F.replace(pick(TEMPLATES, slot), F.lit("{d}"), digits)
    documents = table(spark, sf_dir, "documents")
    noted = documents.select("doc_id", F.concat_ws(" ", "text", sentence).alias("text"))
    bare = documents.filter(slot.isin(NULL_SLOT, EMPTY_SLOT)).select(
        (-F.col("doc_id") - 1).alias("doc_id"), F.when(slot == EMPTY_SLOT, "").alias("text")
    )
    return noted.unionByName(bare)


def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised words in ``conversations``, plus the seed names."""
    pattern = rf"{STARTS}\p{{Lu}}\p{{L}}+{ENDS}"
    words = table(spark, sf_dir, "conversations").select(
        F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("name")
    )
    return words.unionByName(literal_rows(spark, ["name"], [(n,) for n in SEED_NAMES]))


def raw_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every customer, with repeats."""
    customer = table(spark, sf_dir, "customer")
    return customer.select(pick(SEED_STATES, F.col("c_custkey") % len(SEED_STATES)).alias("state"))


def raw_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ZIP code per customer, plus the seed codes."""
    derived = table(spark, sf_dir, "customer").select(
        F.lpad((F.col("c_custkey") * 37 % 100000).cast("string"), 5, "0").alias("ZIP")
    )
    return derived.unionByName(literal_rows(spark, ["ZIP"], [(z,) for z in SEED_ZIPS]))


def raw_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city per page, named after its host, plus the seed cities."""
    codes = STATE_ABBREVIATIONS + FOREIGN_CODES
    host = title_case(F.regexp_extract("url", r"^https?://([^./]+)", 1))
    city = F.when(F.col("page_id") % 5 == 0, F.concat(host, F.lit(" Falls"))).otherwise(host)
    code = pick(codes, F.col("page_id") % len(codes))
    derived = table(spark, sf_dir, "pages").select(
        city.alias("City"),
        code.alias("State_code"),
        F.concat(F.lit("State of "), code).alias("State_full"),
        F.concat(F.lit("County "), (F.col("page_id") % 40).cast("string")).alias("County"),
        host.alias("City alias"),
    )
    return derived.unionByName(literal_rows(spark, CITY_COLUMNS, SEED_CITIES))


def raw_extra_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city per part, named after it, plus the seed cities of the second file."""
    codes = STATE_ABBREVIATIONS + FOREIGN_CODES
    code = pick(codes, F.col("p_partkey") % len(codes))
    key = F.col("p_partkey").cast("string")
    derived = table(spark, sf_dir, "part").select(
        key.alias("Id"),
        code.alias("State_code"),
        F.concat(F.lit("State of "), code).alias("State_full"),
        title_case(F.col("p_name")).alias("City"),
        F.lit(None).cast("string").alias("County"),
        key.alias("LATITUDE"),
        key.alias("LONGITUDE"),
    )
    return derived.unionByName(literal_rows(spark, EXTRA_CITY_COLUMNS, SEED_EXTRA_CITIES))


#: The tables that the lookup tables come from.
LOOKUP_TABLES = ("conversations", "customer", "pages", "part")

_LEXICONS: dict[tuple[str, str], tuple[Row, Lexicon]] = {}


def lexicon(spark: SparkSession, sf_dir: str) -> Lexicon:
    """The lexicon of a folder of tables, built once in a session and again when their files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir)
    files = files_of(spark, sf_dir)
    if key not in _LEXICONS or _LEXICONS[key][0] != files:
        _LEXICONS[key] = files, gazetteers(spark, sf_dir).lexicon()
    return _LEXICONS[key][1]


def files_of(spark: SparkSession, sf_dir: str) -> Row:
    """What tells whether the lookup tables' files are still the same: number, bytes, and a sum of hashes of their names,
    sizes and times. Only the listing is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    rows = listed.load([f"{sf_dir}/{name}.parquet" for name in LOOKUP_TABLES])
    file = F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)")
    return rows.agg(F.count("*"), F.sum("length"), F.sum(file)).first()


def gazetteers(spark: SparkSession, sf_dir: str) -> Gazetteers:
    return build_gazetteers(
        raw_names(spark, sf_dir),
        raw_states(spark, sf_dir),
        raw_zips(spark, sf_dir),
        raw_cities(spark, sf_dir),
        raw_extra_cities(spark, sf_dir),
    )

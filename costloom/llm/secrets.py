"""Secret scan: three base rules, and character Markov models compared by log-likelihood ratio.

Base rules (assign, access, hex) give spans in code points, leftmost and non-overlapping per kind. Two
first-order Markov models of characters are trained on labelled samples. Random strings are the values that the
base rules find and MADE digests in base 64; ordinary identifiers are words with at most one short run of digits, outside the
values of the assign rule, and the list ORDINARY. Each different sample counts once, over all documents; all digits are
one character. Slashes, hyphens and underscores part a token into segments; those without a letter are numbers and say
nothing. A token of at least 16 characters of the alphabet of keys, with a letter in it, becomes a span of kind
`markov` if the ratio of its likelihoods under the two models, of all segments together or of one that has 16 characters
itself, exceeds THRESHOLD and it touches no base span.

Everything is a DataFrame expression. The models are one array of 128 x 128 log ratios, whatever the size
of the corpus, read through a scalar subquery. Null texts count as empty. Repeated rows each get their
result; a table without any sample has those made by rule. Places are summed in blocks of BLOCK matches, so a text's work
grows almost as its matches, but each token is still held against all base spans of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import let, stored

# The base rules.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so shorter ones are the matches that fail
TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 6
MIN_ACCESS = 20
MIN_HEX = 24
#: Characters of a token, and of a segment that counts on its own.
MIN_TOKEN = 16
#: Words with at least this many characters are samples of identifiers, if they have at most one short run of digits.
MIN_WORD = 8
PLAIN = r"^[A-Za-z]+[0-9]{0,4}[A-Za-z]*$"
#: Random samples made by rule, for corpora that label few.
MADE = 256
#: Labelled ordinary words, for corpora that have few identifiers.
ORDINARY = """
python27 utf8 sha256 base64 md5sum node18 java17 http2 ipv4 ipv6 x86 amd64 arm64 mp3 mp4 h264 s3 ec2 k8s
log4j i18n l10n web2 vue3 es2015 html5 css3 sqlite3 libc6 lib64 eth0 tty1 sda1 win32 int64 float32 uint8
page12 chapter7 version2 v1 v10 rc1 beta3 build1024 q1 fy2022 test01 img0001 room101 level3 table3 year2021Report
application development environment configuration database directory document temporary threading network security
authentication authorization permission administrator customer transaction payment inventory warehouse shipping
calendar monthly weekly yearly archive download upload checkpoint snapshot cluster worker scheduler queue buffer
cache memory storage volume thumbnail gallery picture video audio music language translation keyboard screen window
button widget layout template function variable parameter argument return value object method abstract interface
iterator generator exception warning message channel socket protocol address hostname domain username firstName
lastName phoneNumber createdAt updatedAt isEnabled getElementById toString readFileSync parseInt setTimeout
hasNextPage fetchUserProfile onButtonClick maxRetryDelay backgroundColor DataFrameReader HttpResponseFactory
journal article publication analysis experiment measurement temperature weather distance geography hospital
university government election football champion breakfast chocolate vegetable garden furniture
""".split()
#: Characters that part a token into segments.
SEPARATORS = "[/_=-]+"
#: Matches whose lengths are summed at once.
BLOCK = 128
#: Natural-log ratio beyond which a token counts as random: prior odds of one in e^8, about 3,000.
THRESHOLD = 8.0
SIZE = 128
#: Weight of a character's overall frequency in each row of the models, in samples.
BACKOFF = 8.0
_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """(start, kind, end, value) of the matches: what lies between matches gives their places."""

    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def build(parts: Column) -> Column:
        found, gaps = parts["found"], parts["gaps"]
        value = parts["value"] if value_group else found
        # A step is a gap and the match behind it. Sums by blocks keep long texts from quadratic work.
        steps = F.transform(found, lambda m, i: F.length(F.element_at(gaps, i + 1)) + F.length(m))
        blocks = F.sequence(F.lit(0), F.floor(F.size(found) / BLOCK).cast("int"))

        def placed(own: Column, starts: Column) -> Column:
            def start(m: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                inside = total(F.slice(own, block * BLOCK + 1, i - block * BLOCK))
                return F.get(starts, block) + inside + F.length(F.element_at(gaps, i + 1))

            return F.transform(
                found,
                lambda m, i: let(
                    start(m, i),
                    lambda at: F.struct(
                        at.alias("start"),
                        F.lit(kind).alias("kind"),
                        (at + F.length(m)).alias("end"),
                        F.element_at(value, i + 1).alias("value"),
                    ),
                ),
            )

        def summed(own: Column) -> Column:
            sums = F.transform(blocks, lambda b: total(F.slice(own, b * BLOCK + 1, F.lit(BLOCK))))
            return let(
                let(sums, lambda s: F.transform(blocks, lambda b: total(F.slice(s, F.lit(1), b)))),
                lambda starts: placed(own, starts),
            )

        return let(steps, summed)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    gaps = F.split(text, pattern, -1).alias("gaps")
    value = [F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value")] if value_group else []
    hits = let(F.struct(found, gaps, *value), build)
    return F.when(text.rlike(pattern), hits).otherwise(F.array()).cast(f"array<{_SPAN}>")


def base_spans(text: Column) -> Column:
    """All spans of the base rules, by start and kind."""
    assign = F.filter(_spans(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_VALUE)
    access = F.filter(_spans(text, ACCESS, 1), lambda s: F.length(s["value"]) >= MIN_ACCESS)
    hexes = _spans(text, HEX, 2)
    return F.array_sort(F.concat(assign, access, hexes))


def _code(value: Column) -> Column:
    return F.least(F.ascii(value), F.lit(SIZE - 1))


def _segments(value: Column) -> Column:
    """The parts of a string between slashes, hyphens and the like that have a letter in them."""
    return F.filter(F.split(value, SEPARATORS, -1), lambda s: s.rlike("[A-Za-z]"))


def _moves(value: Column) -> Column:
    """Index of each (previous character, character) of a string; 0 stands before the first, one digit for all.

    Strings without a small letter are read as small ones: capitals alone are no sign of a key.
    """
    folded = F.when(value.rlike("[a-z]"), value).otherwise(F.lower(value))
    chars = F.split(F.translate(folded, "123456789", "000000000"), "")
    return let(
        F.transform(chars, _code),
        lambda codes: F.transform(
            codes, lambda c, i: F.when(i == 0, 0).otherwise(F.get(codes, i - 1)) * SIZE + c
        ),
    )


def models(scanned: DataFrame) -> DataFrame:
    """One row `ratio`: log P(next | previous) of random strings minus that of identifiers, smoothed.

    `scanned` holds `text` and `base` (spans).
    """
    spark = scanned.sparkSession
    made = spark.range(MADE).select(F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))).alias("sample"))
    random = made.union(scanned.select(F.explode("base.value").alias("sample")))
    random = random.select(F.explode(_segments(F.col("sample"))).alias("sample")).distinct().withColumn("random", F.lit(1))
    words = scanned.select(F.explode(F.split(F.regexp_replace("text", ASSIGN, " "), r"[^A-Za-z0-9]+", -1)).alias("sample"))
    words = words.filter((F.length("sample") >= MIN_WORD) & F.col("sample").rlike(PLAIN))
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in ORDINARY])).alias("sample"))
    plain = listed.union(words).distinct().withColumn("random", F.lit(0))
    counts = (
        random.union(plain)
        .select("random", F.explode(_moves(F.col("sample"))).alias("move"))
        .groupBy("move")
        .agg(F.sum("random").alias("r"), F.sum(1 - F.col("random")).alias("p"))
    )
    cells = scanned.sparkSession.range(SIZE * SIZE).select(F.col("id").cast("int").alias("move"))
    full = cells.join(counts, "move", "left").select(
        "move", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("p", F.lit(0)).alias("p")
    )
    rows = full.groupBy(F.shiftright("move", 7).alias("row")).agg(F.sum("r").alias("r_row"), F.sum("p").alias("p_row"))
    chars = full.groupBy(F.col("move").bitwiseAND(F.lit(SIZE - 1)).alias("char")).agg(
        F.sum("r").alias("r_char"), F.sum("p").alias("p_char")
    )
    total = full.agg(F.sum("r").alias("r_all"), F.sum("p").alias("p_all"))
    r_all, p_all = total.select("r_all").scalar(), total.select("p_all").scalar()

    def log_p(n: str, row: str, char: str, every: Column) -> Column:
        usual = (F.col(char) + 0.5) / (every + 0.5 * SIZE)
        return F.log((F.col(n) + BACKOFF * usual) / (F.col(row) + BACKOFF))

    smooth = (
        full.join(rows, F.shiftright(full["move"], 7) == rows["row"])
        .join(chars, full["move"].bitwiseAND(F.lit(SIZE - 1)) == chars["char"])
        .select("move", (log_p("r", "r_row", "r_char", r_all) - log_p("p", "p_row", "p_char", p_all)).alias("ratio"))
    )
    return smooth.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("move", "ratio"))), lambda x: x["ratio"]).alias("ratio")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(text, ",")


def scan_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, text, base (spans), extra (markov spans with their ratio)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    model = stored(models(scanned.select("text", "base")), "markov")
    ratio = model.select("ratio").scalar()
    tokens = _spans(F.col("text"), TOKEN, 3)

    def score(table: Column, value: Column) -> Column:
        def one(segment: Column) -> Column:
            return F.aggregate(_moves(segment), F.lit(0.0), lambda a, m: a + F.element_at(table, m + 1))

        def both(parts: Column) -> Column:
            ratios = F.transform(parts, lambda p: F.struct(F.length(p).alias("size"), one(p).alias("ratio")))
            return let(
                ratios,
                lambda found: F.greatest(
                    F.aggregate(found, F.lit(0.0), lambda a, x: a + x["ratio"]),
                    F.array_max(F.transform(F.filter(found, lambda x: x["size"] >= MIN_TOKEN), lambda x: x["ratio"])),
                ),
            )

        return let(_segments(value), both)

    free = F.filter(
        "tokens",
        lambda t: t["value"].rlike("[A-Za-z]") & ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    scored = F.transform(
        free,
        lambda t: F.struct(
            t["start"].alias("start"),
            t["kind"].alias("kind"),
            t["end"].alias("end"),
            t["value"].alias("value"),
            score(F.col("ratio"), t["value"]).alias("ratio"),
        ),
    )
    return (
        scanned.withColumn("ratio", ratio)
        .withColumn("tokens", tokens)
        .select("doc_id", "text", "base", F.filter(scored, lambda t: t["ratio"] > threshold).alias("extra"))
    )


def secret_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 and spans of every row."""
    found = scan_secrets(docs, threshold)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    extra = F.transform(
        "extra",
        lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"), t["value"].alias("value")),
    )
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.size("extra").cast("long").alias("n_markov"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", extra))).alias("spans"),
    )

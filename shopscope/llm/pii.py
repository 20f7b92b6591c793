"""Personal data: fixed patterns, and boosted trees over wider candidates. DataFrame operations only.

Each text is matched once per pattern. The pieces between matches give every
match its place, so spans are found with built-in functions and a running sum.

* ``BASE`` patterns and their checks define spans that always count.
* ``WIDE`` generators propose more, overlapping ones: addresses with written or
  bracketed signs, numbers with other separators, numbers without a plus sign.
* Every candidate has a few small integer features of its format and context.
  Trees learn from three kinds of rows, counted per distinct feature vector over
  all documents: confirmed spans and their rewritten forms (``FORMS``: the same
  address or number as people disguise it, in the same context) are positive;
  candidates whose numbers fail their kind's check are negative; ``SEEDS``, a
  short fixed list of labelled phrases, are both, so that a table without any
  confirmed span has a model too. Candidates that pass the check are not rows.
  Counts are scaled to the same total per kind and label, so a model does not
  depend on the size of the table. The trees become plain column expressions.
* Documents whose text hashes to 0 of ``HELD`` don't train; they calibrate.
  Per kind, the threshold is the lowest score from 0.5 on at which the share of
  positives kept is ``PRECISION`` of the shares of positives and negatives kept.
  Candidates above it whose numbers pass their kind's check and that overlap
  neither a base span nor an earlier one are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.shared import made, numbered, parted, unused, written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
TREES = 12
DEPTH = 5
#: One of this many hashes of texts is held out of training.
HELD = 5
#: Failing check digits stand for a ninth as many numbers that pass by chance.
CHANCE = {"card": 1 / 9}
SEED = 8

# The base patterns. Possessive parts and the boundary before an address's first
# character give the plain patterns' leftmost matches without trying every start in a long run; a
# card has 12 digits at least, so shorter chains need no match.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:(?: ?[(\[{<]dot[)\]}>] ?| dot )[A-Za-z0-9_%+-]{1,64}+){0,3}+(?: ?(?:@|[(\[{<]at[)\]}>]) ?| at )"
             r"[A-Za-z0-9-]{1,63}+(?:(?:\.| \. | ?[(\[{<]dot[)\]}>] ?| dot )[A-Za-z0-9-]{1,63}+){1,5}+",
    "ip": r"(?i)(?<![0-9.,:])[0-9]{1,3}+(?:(?: ?(?:\.|[(\[{]\.[)\]}]|[(\[{]dot[)\]}]) ?|[,:]| dot )[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ ./_-]{0,3}[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9.+/-])\+?(?:\(?[0-9]{1,4}+\)?(?:[ ./-]{1,2}\(?[0-9]{2,8}+\)?){2,5}+|(?<![A-Za-z])[0-9]{9,15}+(?![A-Za-z]))(?![0-9])",
}
# What a text must hold for a pattern to match at all.
NEEDS = {
    "email": r"(?i)@|[(\[{<]at[)\]}>]| at [^ ]+( dot |[.])", "ip": r"(?i)[0-9] ?(?:[.,:]|[(\[{]\.|[(\[{]dot| dot )", "card": r"[0-9][ ./_-]{0,3}[0-9]",
    "phone": r"[0-9][ ().0-9/-]"}
HINTS = {
    "email": "mail|contact|write|reach", "ip": r"\bip\b|host|address|server|ping|login", "card": "card|visa|credit|account|master|amex|pay",
    "phone": r"phone|\btel|call|fax|mobil|contact|cell|\btext|whatsapp|\bsms|\bring\b|dial"}
DOUBTS = (r"isbn|issn|\border|invoice|\bdate|version|\bpages?\b|chapter|serial|\bsku\b|ticket|tracking|\bid\b|\bref|score|\blines?\b|section|between"
          r"|\b(?:arrived?|look|looked|met|meet|sold|aimed|good|was|is|are|were|be|stood|stay|available|the|a|and|or|site|read|visit)$")
FEATURES = (
    "kind_no", "digits", "groups", "zeros", "first", "last", "dots", "dashes", "spaces", "brackets", "others", "letters", "at_form", "dot_form", "ending", "before", "after", "hint", "doubt")

# Labelled phrases: (kind, phrase) holds personal data of the kind, (None, phrase) none at all.
SEEDS = (
    ("email", "write to anna.k (at) example (dot) com today"), ("email", "reach me: joe[at]mail.example[dot]org"), ("email", "mail bob at example dot net please"),
    ("email", "contact eva @ example.com now"), ("email", "my address is li{at}example{dot}edu"), ("email", "so max dot lee at web dot example dot org, thanks"), ("email", "send it to k_99(at)example.com"),
    ("ip", "the server is 10 . 20 . 30 . 40 here"), ("ip", "ping 192[.]168[.]1[.]77 first"), ("ip", "host 172 dot 16 dot 9 dot 200 answers"), ("ip", "from 81(dot)2(dot)69(dot)142 again"), ("ip", "he used 8. 8. 4. 4 once"),
    ("card", "card 4111.1111.1111.1111 expires soon"), ("card", "pay with 5500/0000/0000/0004 please"), ("card", "use 4012 - 8888 - 8888 - 1881 then"), ("card", "visa 4222_2222_2222_2220 was used"), ("card", "the number 3400.000000.00009 is his"),
    ("phone", "call (415) 555-0132 after six"), ("phone", "tel. 030 1234 5678"), ("phone", "my mobile is 0171-555-0199-2"), ("phone", "fax: 212.555.0147"), ("phone", "dial 0049 30 555 01 23"), ("phone", "phone 4155550132 tonight"),
    ("phone", "text me on +49/30/5550123"), ("phone", "reach us at 1-800-555-0100 daily"), ("phone", "the office, 415 555 0132, is open"), ("phone", "and (212) 555 0199 too"), ("phone", "so 646.555.0171 or later"),
    ("email", "my mail is kim.s@example.org"), ("email", "contact: info@mail.example.com"), ("ip", "server 10.20.30.40 is up"), ("ip", "host 203.0.113.9"),
    ("card", "card 4111 1111 1111 1111"), ("card", "visa 4012-8888-8888-1881 works"), ("card", "pay by 378282246310005 now"),
    ("phone", "call +1 (212) 555-0188 now"), ("phone", "tel +49 30 5550 1234"), ("phone", "dial +44 20 7946 0018"), ("phone", "mobile +1 646-555-0107 is mine"),
    ("phone", "she has +43 512 345 678 too"), ("phone", "or +33 612 345 678"), ("ip", "later 198.51.100.27 as well"), ("ip", "and 88.12.140.201"),
    (None, "we look at example.com often"), (None, "she arrived at gate dot matrix printers"), (None, "he was at home.he slept"), (None, "read more at www.example.org/news"), (None, "available at shop.example.net now"),
    (None, "and met at noon.then we left"), (None, "good at math.she won"), (None, "the team is at work.today"), (None, "sold at market dot point"), (None, "visit us at blog.example.com"), (None, "or a sign at road.side"),
    (None, "rooms 1,2,3,4 are free"), (None, "at 10:20:30:40 the clock"), (None, "scores 12,15,18,21 in order"), (None, "a ratio of 4:3:2:1 holds"), (None, "12,30,45,60 minutes"), (None, "lot 7:14:21:28"),
    (None, "order 2024.1234.5678.9016 shipped"), (None, "serial 1234/5678/9012/3452 broken"), (None, "tracking id 1234-567890-123456"), (None, "invoice 7700_1200_3400_5605 is due"), (None, "ticket 6000.1111.2222.3339 closed"),
    (None, "on 12 10 2023 14 30 we met"), (None, "isbn 0-306-40615-2 is a book"), (None, "order 123456789 was sent"), (None, "pages 100-120-140-160 differ"), (None, "version 10.12.14.16.18 came"), (None, "tracking id 9400110200881"),
    (None, "lines 1000 2000 3000 4000 5000"), (None, "between 1914-1918 1939-1945"), (None, "ref 20231145 221199 out"), (None, "serial 5566778899 stolen"), (None, "sku 12-3456-789 sold"), (None, "score 100-200-300 wins"),
    (None, "values 10 20 30 40 50 60"), (None, "sizes 100/200/300/400"), (None, "from 11.12.13 14 15 on"), (None, "population 1000000000 people"), (None, "about 123456789012 stars"),
)


def _counted(x: Column, chars: str, most: int) -> Column:
    return F.least(F.length(x) - F.length(F.translate(x, chars, "")), F.lit(most))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""

    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _octets(x: Column) -> Column:
    return F.forall(F.split(x, "[.,:]"), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _n_digits(x: Column) -> Column:
    return F.length(_digits(x))


def _valid(kind: Column, x: Column, wide: Column) -> Column:
    """Whether a match has the right numbers: parts, check digit, count of digits. Wide matches
    moreover need a last label of letters, and digits that are neither a date nor an ISBN."""
    n = _n_digits(x)
    parts = F.trim(F.regexp_replace(x, "[^0-9]+", "."), F.lit("."))
    card = n.between(12, 19) & luhn(F.substring(_digits(x), F.lit(1), F.lit(20)))
    label = x.rlike(r"(?<![A-Za-z0-9-])[A-Za-z]{2,24}$")
    day = r"(?:0?[1-9]|[12][0-9]|3[01])[ ./-]{1,2}(?:0?[1-9]|1[0-2])[ ./-]{1,2}(?:19|20)[0-9]{2}(?![0-9])"
    date = x.rlike(r"^\(?(?:19|20)[0-9]{2}[ ./-]{1,2}(?:0?[1-9]|1[0-2])[ ./-]{1,2}(?:0?[1-9]|[12][0-9]|3[01])(?![0-9])|^" + day) | _digits(x).rlike("^97[89][0-9]{10}$")
    phone = n.between(9, 15) & ~(wide & date)
    return F.when(kind == "email", ~wide | label).when(kind == "ip", _octets(F.when(wide, parts).otherwise(x))).when(kind == "card", card).otherwise(phone)


def _char_class(c: Column) -> Column:
    """Kind of a neighbouring character; the ends of a text count as white space."""
    return F.when(c.isNull() | (c == "") | c.rlike(r"^\s"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\p{L}"), 3).otherwise(4)


def candidates(docs: DataFrame, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(all rows: row and doc_id; all matches: row, held, wide, kind, start, end, match and context). Rows
    are numbered here, unless the column ``row`` has their numbers; phrase i of SEEDS is row -1 - i."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<skip:int,before:string,after:string,match:string>>")

    def matched(kind: str, wide: bool) -> Column:
        pattern = F.lit((WIDE if wide else BASE)[kind])
        found = F.regexp_extract_all(F.col("text"), pattern, F.lit(0))
        pieces = F.split(F.col("text"), (WIDE if wide else BASE)[kind], -1)
        each = F.transform(found, lambda m, i: F.struct(
            F.length(F.get(pieces, i)).alias("skip"), F.right(F.get(pieces, i), F.lit(32)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(1)).alias("after"), m.alias("match")))
        return F.when(F.col(f"has_{kind}"), each).otherwise(none)

    row = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    said = F.get(F.array(*(F.lit(phrase) for _, phrase in SEEDS)), F.col("id").cast("int"))
    phrases = docs.sparkSession.range(len(SEEDS)).select((-1 - F.col("id")).alias("row"), F.lit(None).cast("long").alias("doc_id"), said.alias("text"))
    rows = rows.union(phrases)
    rows = rows.select("*", (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0).alias("held"), *(F.col("text").rlike(NEEDS[k]).alias(f"has_{k}") for k in KINDS))
    of = [F.struct(F.lit(w).alias("wide"), F.lit(k).alias("kind"), matched(k, w).alias("matches")) for w in (False, True) for k in KINDS]
    found = F.filter(F.array(*of), lambda x: F.size(x["matches"]) > 0)
    seen = written(rows.select("row", "doc_id", "held", found.alias("found")), "matches")
    each = seen.select("row", "held", F.explode("found").alias("f")).select("row", "held", "f.wide", "f.kind", F.posexplode("f.matches").alias("i", "m")).select("row", "held", "wide", "kind", "i", "m.*")
    so_far = Window.partitionBy("row", "wide", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("skip").cast("long") + F.length("match")).over(so_far)
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    return seen.filter("row >= 0").select("row", "doc_id"), spans.select("row", "held", "wide", "kind", "start", "end", "match", "before", "after")


def checked(spans: DataFrame) -> DataFrame:
    """Base spans that pass their check, and wide candidates with the outcome of theirs. A wide
    candidate that overlaps a base span of its kind is that span again and goes."""
    kind = F.col("kind")
    spans = spans.withColumn("valid", _valid(kind, F.col("match"), F.col("wide"))).filter("wide or valid")
    number = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")
    spans = spans.withColumn("kind_no", number).withColumn("base", ~F.col("wide")).drop("wide")
    return _clear_of_base(spans, "row", "kind")


def featured(spans: DataFrame) -> DataFrame:
    """Spans with the features of their match and context."""
    kind, x = F.col("kind"), F.col("match")
    groups = F.split(F.trim(F.regexp_replace(x, "[^0-9]+", " ")), " ")
    hint = F.lit(False)
    for k in KINDS:
        hint = F.when(kind == k, F.lower("before").rlike(HINTS[k])).otherwise(hint)
    at_form = F.when(x.rlike(r"(?i)[(\[{<]at[)\]}>]"), 1).when(x.rlike("(?i) at "), 2).when(x.rlike(" @|@ "), 3).otherwise(0)
    dot_form = F.when(x.rlike(r"(?i)[(\[{<](?:dot|\.)[)\]}>]"), 1).when(x.rlike("(?i) dot "), 2).when(x.rlike(r" \.|\. "), 3).otherwise(0)
    own = {
        "digits": F.least(_n_digits(x), F.lit(20)), "groups": F.least(F.size(groups), F.lit(8)), "zeros": F.least(F.length(F.regexp_extract(_digits(x), "^0*", 0)), F.lit(2)),
        "first": F.least(F.length(F.get(groups, F.lit(0))), F.lit(9)),
        "last": F.least(F.length(F.element_at(groups, -1)), F.lit(9)), "dots": _counted(x, ".", 5), "dashes": _counted(x, "-", 5), "spaces": _counted(x, " ", 8), "brackets": _counted(x, "()[]{}", 4),
        "others": _counted(x, "/_,:", 5), "letters": x.rlike("[A-Za-z]").cast("int"), "at_form": at_form, "dot_form": dot_form,
        "ending": x.rlike("(?i)(?:com|org|net|edu|gov|info|[^a-z][a-z]{2})$").cast("int"),
        "hint": hint.cast("int"), "doubt": F.lower(F.rtrim("before")).rlike(DOUBTS).cast("int"),
        "before": _char_class(F.regexp_replace(F.right("before", F.lit(1)), r"[+(]", "")), "after": _char_class(F.col("after"))}
    # counts of an address say nothing of its kind: names hold any digits
    for name in ("digits", "groups", "zeros", "first", "last", "dots", "dashes", "spaces", "others"):
        own[name] = F.when(kind == "email", 0).otherwise(own[name])
    return spans.select([c for c in spans.columns if c not in own] + [c.alias(n) for n, c in own.items()])


def _forms(kind: Column, x: Column) -> Column:
    """A base span's match and the forms in which people write the same address or number."""
    four = lambda sep: F.regexp_replace(_digits(x), "([0-9]{4})(?=[0-9])", f"$1{sep}")
    bare = F.substring(x, 2, 1 << 20)
    short = F.regexp_replace(x, r"^\+[0-9]{1,3}[ .-]+(?=(?:[^0-9]*[0-9]){9})", "")
    parted = lambda x, sep: F.regexp_replace(F.regexp_replace(x, "[^0-9]+", sep), "^[^0-9]+|[^0-9]+$", "")
    email = [(" (at) ", " (dot) "), ("[at]", "."), (" at ", " dot "), (" @ ", "."), ("(at)", "(dot)"), ("@", "[dot]")]
    forms = {
        "email": [x, *(F.replace(F.replace(x, F.lit("."), F.lit(dot)), F.lit("@"), F.lit(at)) for at, dot in email)],
        "ip": [x, *(F.replace(x, F.lit("."), F.lit(dot)) for dot in (" . ", "[.]", " dot ", "(dot)", ". "))],
        "card": [x, *(four(sep) for sep in (".", "/", "_", " - "))],
        "phone": [bare, short, *(parted(short, sep) for sep in (".", "-", " ", "/", "")), *(parted(bare, sep) for sep in (".", "-", " ")), *(F.concat(F.lit("00"), parted(bare, sep)) for sep in (" ", "-"))],
    }
    out = F.array().cast("array<string>")
    for k in KINDS:
        out = F.when(kind == k, F.array_distinct(F.array(*forms[k]))).otherwise(out)
    return out


def examples(spans: DataFrame) -> DataFrame:
    """Counted feature vectors to learn from: FEATURES, label, held, seed and their weight n."""
    kind, row = F.col("kind"), F.col("row")
    wanted = F.get(F.array(*(F.lit(k) for k, _ in SEEDS)), (-1 - row).cast("int"))
    said = spans.filter("row < 0 and not base").withColumn("label", F.coalesce(wanted == kind, F.lit(False)))
    said = said.filter(F.col("label") | wanted.isNull())
    failed = spans.filter("row >= 0 and not base and not valid").withColumn("label", F.lit(False))
    sure = spans.filter("base").withColumn("match", F.explode(_forms(kind, F.col("match")))).withColumn("label", F.lit(True))
    sure = sure.filter(_valid(kind, F.col("match"), F.lit(True)) | (kind == "email"))
    # each also without the words before it, or trees would know the words of the corpus only
    sure = sure.withColumn("before", F.explode(F.array_distinct(F.array("before", F.right("before", F.lit(1))))))
    weight = F.lit(1.0)
    for k, w in CHANCE.items():
        weight = F.when((kind == k) & ~F.col("label") & (row >= 0), w).otherwise(weight)
    rows = featured(said.union(failed.select(said.columns)).union(sure.select(said.columns)).withColumn("n", weight).withColumn("seed", row < 0))
    # a plain run of digits is a phone number only where words say so
    rows = rows.filter("not (label and kind = 'phone' and groups = 1 and hint = 0)")
    return rows.groupBy(*FEATURES, "label", "held", "seed").agg(F.sum("n").alias("n"))


def _balanced(cells: DataFrame) -> DataFrame:
    """Cells with a weight that adds up to 100 per kind, label and origin."""
    return cells.withColumn("weight", F.col("n") * 100 / F.sum("n").over(Window.partitionBy("kind_no", "label", "seed")))


def _clear_of_base(spans: DataFrame, *group: str) -> DataFrame:
    """Spans without those that are not base and overlap a base span of the group."""
    by = Window.partitionBy(*group).orderBy("start", "end")
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(by.rowsBetween(1, Window.unboundedFollowing))
    marked = spans.withColumn("b_end", base_end).withColumn("b_start", base_start)
    clear = F.coalesce(F.col("b_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("b_start") >= F.col("end"), F.lit(True))
    return marked.filter(F.col("base") | clear).drop("b_end", "b_start")


def _clear_of_kept(spans: DataFrame) -> DataFrame:
    """Spans that overlap no earlier span that stays. Spans that overlap one after another form a
    chain, which is gone through in order."""
    columns = spans.columns
    by = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind_no")
    until = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    chained = spans.withColumn("fresh", F.coalesce((until <= F.col("start")).cast("int"), F.lit(1)))
    chained = chained.withColumn("chain", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rest = [c for c in columns if c not in ("row", "start", "end", "kind_no")]
    one = F.struct("start", (-F.col("end")).alias("back"), "kind_no", "end", *rest)
    chains = chained.groupBy("row", "chain").agg(F.array_sort(F.collect_list(one)).alias("s"))
    last = lambda kept: F.get(kept, F.size(kept) - 1)["end"]
    kept = F.aggregate(F.slice("s", 2, F.greatest(F.size("s"), F.lit(1))), F.slice("s", 1, 1), lambda kept, x: F.when(last(kept) <= x["start"], F.concat(kept, F.array(x))).otherwise(kept))
    return chains.select("row", F.explode(kept).alias("x")).select("row", "x.*").select(*columns)


def _tree(node, value) -> Column:
    """A regression tree of the fitted model as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(value(split.featureIndex()) <= float(split.threshold()), _tree(node.leftChild(), value)).otherwise(_tree(node.rightChild(), value))


def boosted(cells: DataFrame) -> Column:
    """The score of a candidate as a column of its features, learned from weighted cells."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(cells).select("x", F.col("label").cast("double").alias("label"), "weight")
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.5, seed=SEED, minInfoGain=0.0).fit(data)
    margin = F.lit(0.0)
    for weight, tree in zip(model.treeWeights, model.trees):
        margin = margin + float(weight) * _tree(tree._call_java("rootNode"), lambda i: F.col(FEATURES[i]))
    return 1 / (1 + F.exp(-2 * margin))


def calibrated(cells: DataFrame, score: Column) -> dict[int, float]:
    """Per kind the lowest score that keeps PRECISION, from the weighted cells."""
    share = lambda label: F.sum(F.when(F.col("label") == label, F.col("weight")).otherwise(0.0))
    levels = cells.withColumn("score", score).groupBy("kind_no", "score").agg(share(True).alias("yes"), share(False).alias("no"))
    down, whole = Window.partitionBy("kind_no").orderBy(F.desc("score")), Window.partitionBy("kind_no")
    kept = {c: F.coalesce(F.sum(c).over(down) / F.nullif(F.sum(c).over(whole), F.lit(0.0)), F.lit(0.0)) for c in ("yes", "no")}
    levels = levels.select("kind_no", "score", F.lead("score").over(down).alias("next"), *(c.alias(n) for n, c in kept.items()))
    good = levels.filter((F.col("score") >= 0.5) & (F.col("yes") > 0) & (F.col("yes") >= PRECISION * (F.col("yes") + F.col("no"))))
    # no example lies between a level and the next lower one: the limit is half-way
    halfway = F.greatest(F.lit(0.5), (F.col("score") + F.coalesce("next", F.lit(0.0))) / 2)
    return {r["kind_no"]: r["least"] for r in good.groupBy("kind_no").agg(F.min(halfway).alias("least")).collect()}  # one per kind at most


def personal_data(docs: DataFrame, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows: row, doc_id; spans: row, kind, kind_no, start, end, base): base spans and added ones.

    Offsets are in code points, the end exclusive. Null texts are empty and hold nothing. Repeated
    rows are looked at each. A kind for which no score keeps the precision adds nothing.
    """
    rows, spans = candidates(docs, row)
    spans = written(checked(spans), "candidates")
    # as many rows as there are feature vectors, whatever the number of documents
    cells = written(examples(spans).repartition(1).sortWithinPartitions(*FEATURES, "label", "held", "seed"), "cells")
    score = boosted(_balanced(cells.filter("seed or not held")))
    limits = calibrated(_balanced(cells.filter("seed or held")), score)
    limit = F.lit(2.0)
    for k, v in sorted(limits.items()):
        limit = F.when(F.col("kind_no") == k, F.lit(v)).otherwise(limit)
    spans = spans.filter("row >= 0")
    place = ["row", "kind", "kind_no", "start", "end", "base"]
    # the trees ask for a feature in many places: in a plan with the features' own expressions, each place would repeat them
    # (megabytes of plan and code on the driver); the rows that trees and limits pass are stored, so no later plan holds the trees
    known = written(featured(spans.filter("not base and valid")).select(*dict.fromkeys([*place, *FEATURES])), "features")
    extra = written(known.withColumn("score", score).filter(F.col("score") >= limit).select(*place), "added")
    base = spans.filter("base").select(*place)
    # clear of base spans of any kind, and of each other: the earlier one stays
    extra = _clear_of_base(base.union(extra), "row").filter("not base")
    return rows, base.union(_clear_of_kept(extra))


def _listed(spans: DataFrame) -> DataFrame:
    """Per row: counts of base spans, and base and all spans as text."""
    one = F.struct("start", "kind_no", "end", "kind", "base")
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("s"), F.count(F.lit(1)).alias("n_spans"), *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS))
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return listed.select("row", "n_spans", *(f"n_{k}" for k in KINDS), text(F.filter("s", lambda x: x["base"])).alias("base"), text(F.col("s")).alias("spans"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans) for every row of ``docs``;
    counts per kind are of base spans, ``n_spans`` of all. An empty table gives an empty result. Other columns are ignored."""
    rows, spans = personal_data(docs)
    joined = rows.join(_listed(spans), "row", "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return joined.select("doc_id", *counts, F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with each found span replaced by its kind in angle brackets.
    Overlapping spans are replaced together, named by the first. Null texts stay null."""
    own, held = unused(docs, "pii_row"), unused(docs, "pii_cuts")
    docs, columns = numbered(docs, own), docs.columns

    def found() -> DataFrame:
        _, spans = personal_data(docs, own)
        by = Window.partitionBy("row").orderBy("start", "kind_no")
        until = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
        joint = spans.withColumn("fresh", F.coalesce((until <= F.col("start")).cast("int"), F.lit(1)))
        joint = joint.withColumn("no", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        joint = joint.groupBy("row", "no").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.when(F.col("fresh") == 1, F.col("kind"))).alias("kind"))
        cuts = joint.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("pii_cuts"))
        return cuts.select(F.col("row").alias(own), F.col("pii_cuts").alias(held))

    cuts = made(docs.sparkSession, "cuts", found)
    # only texts that may have cuts are shuffled
    may, whole = parted(docs, own, cuts)
    rows = may.join(cuts, own, "left")
    at = F.col(held)

    def piece(x: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(at, i - 1)["end"])
        return F.concat(F.substring(F.col("text"), (start + 1).cast("int"), (x["start"] - start).cast("int")), F.lit("<"), F.upper(x["kind"]), F.lit(">"))

    tail = F.substring(F.col("text"), (F.element_at(at, -1)["end"] + 1).cast("int"), F.length("text"))
    text = F.when(at.isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform(at, piece), ""), tail))
    return rows.withColumn("text", text).select(*columns).union(whole.select(*columns))

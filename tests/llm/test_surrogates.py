"""Detection and replacement against plain Python, distinctness, coreference and formats."""

import re
from collections import Counter

from pyspark.sql import functions as F

from marinelake.llm.surrogates import op9_pii_surrogates, replace_personal_data, with_surrogates

SF = "/root/testdata/sf0.01"
#: What the generator of the table plants.
PLANTED = re.compile(
    r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b|(?<=[nN] = \")[0-9a-fA-F]{40}(?=\")|(?<=EN = \")[0-9A-F]{40}|\+\d \(\d{3}\) \d{3}-\d{4}"
)


def test_table(spark):
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    after = {r["doc_id"]: r for r in op9_pii_surrogates(spark, SF).collect()}
    assert before.keys() == after.keys()
    mapped, planted = {}, 0
    for i, text in before.items():
        old, new = PLANTED.findall(text), after[i]["text"]
        assert (after[i]["n_entities"] > 0) == bool(old) and (old or text == new)
        planted += len(old)
        for value in old:
            assert value not in new
        # What stands between stays.
        assert PLANTED.split(text) == PLANTED.split(new)
        for value, made in zip(old, PLANTED.findall(new)):
            assert mapped.setdefault(value.lower(), made.lower()) == made.lower()
    assert planted and len(set(mapped.values())) == len(mapped) and not set(mapped) & set(mapped.values())


def test_types_formats_gender_and_script(spark):
    rows = [
        (1, "Mail Anna.B@Corp.example.com or ANNA.B@CORP.EXAMPLE.COM; 4111 1111 1111 1111 and 4111111111111111, ip 10.0.0.1"),
        (2, "Mrs. Erika Mustermann met Mr Smith and г-жа Иванова; (555) 123-4567, 123-45-6789, DE89 3704 0044 0532 0130 00."),
        (3, "Mrs. Erika Mustermann wrote to b@corp.example.com: password = 's3cret-Word'; version 4.0, 1.2.3, 2024-01-02"),
    ]
    texts = {r["doc_id"]: r["text"] for r in replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    low, high = re.search(r"Mail (\S+) or (\S+);", texts[1]).groups()
    assert low == high.lower() != "anna.b@corp.example.com" and low.endswith(".example")
    spaced, joined = re.search(r"; (\d{4} \d{4} \d{4} \d{4}) and (\d{16}),", texts[1]).groups()
    assert spaced.replace(" ", "") == joined != "4111111111111111"
    luhn = [int(c) for c in joined[::-1]]
    assert (sum(luhn[::2]) + sum(sum(divmod(2 * d, 10)) for d in luhn[1::2])) % 10 == 0
    lady = re.match(r"Mrs\. (\w+ \w+) met Mr ([A-Z][a-z]+) and г-жа ([А-Я][а-я]+); \(\d{3}\) \d{3}-\d{4}, \d{3}-\d{2}-\d{4}, DE\d{2} (?:\d{4} ){4}\d{2}\.$", texts[2])
    assert lady and texts[3].startswith(f"Mrs. {lady[1]} wrote to ")
    from marinelake.llm.surrogates import GIVEN

    assert lady[1].split()[0] in GIVEN["latin", "f"]
    # One host, one surrogate host; what only looks alike stays.
    assert re.search(r"to \w@([\w.]+):", texts[3])[1] == low.split("@")[1]
    assert re.search(r"password = '[a-z]\d[a-z]{4}-[a-z]{4}'; version 4\.0, 1\.2\.3, 2024-01-02$", texts[3])


def test_collisions_are_drawn_again(spark):
    """A generator with few results, one of them an original, still ends distinct."""

    def poor(entities, key):
        number = F.pmod(F.xxhash64("normal"), F.lit(3)) + F.col("draw") * 2
        return entities.withColumn("made", F.concat(F.lit("user"), number.cast("string"), F.lit("@x.example.com")))

    mails = [f"m{i}@a.example.com" for i in range(9)] + ["user1@x.example.com"]
    df = spark.createDataFrame([(i, f"to {m} and {m}") for i, m in enumerate(mails)], "doc_id int, text string")
    made = {}
    for r in replace_personal_data(df, drawn_by=poor).collect():
        one, two = re.fullmatch(r"to (\S+) and (\S+)", r["text"]).groups()
        assert one == two
        made[mails[r["doc_id"]]] = one
    assert len(set(made.values())) == len(mails) and not set(made.values()) & set(mails)
    assert with_surrogates


def test_odd_rows(spark, odd, empty):
    assert sorted(map(str, replace_personal_data(odd).collect())) == sorted(map(str, odd.collect()))
    assert replace_personal_data(empty).count() == 0
    rows = [(1, "a@b.example.org", "x"), (1, "a@b.example.org", "x"), (None, "a@b.example.org " * 500, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _found string")
    got = replace_personal_data(df, counted="n").collect()
    assert Counter((r["doc_id"], r["_found"], r["n"]) for r in got) == Counter([(1, "x", 1), (1, "x", 1), (None, None, 500)])
    assert len({word for r in got for word in r["text"].split()}) == 1


def test_crowded_types_end(spark):
    """More short addresses than short surrogates, and a type whose draws never end."""
    mails = [f"{c}@{h}.io" for c in "abcdefghijklmnopqrstuvwxyz" for h in "abcdefgh"]
    df = spark.createDataFrame([(i, f"to {m} now") for i, m in enumerate(mails)], "doc_id int, text string")
    made = [re.fullmatch(r"to (\S+@\S+) now", r["text"])[1] for r in replace_personal_data(df).collect()]
    assert len(set(made)) == len(mails) and not set(made) & set(mails)

    def stuck(entities, key):
        return entities.withColumn("made", F.lit("x@y.example"))

    few = spark.createDataFrame([(i, f"to {m} now") for i, m in enumerate(mails[:3])], "doc_id int, text string")
    made = [re.fullmatch(r"to (\S+) now", r["text"])[1] for r in replace_personal_data(few, drawn_by=stuck).collect()]
    assert len(set(made)) == 3 and not set(made) & set(mails) and sum(m.startswith("[surrogate-") for m in made) == 2


def test_names_of_many_forms(spark):
    names = ["Mrs. Mary Jane Watson", "Mr Jan van der Berg", "Mrs Anne-Marie Keller", "Ms O'Neill", "Herr von Stein", "Dr Mary Jane Watson", "3782 822463 10005"]
    df = spark.createDataFrame([(i, f"then {n}, who left") for i, n in enumerate(names)], "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in replace_personal_data(df).collect()}
    for i, n in enumerate(names):
        inside = re.fullmatch(r"then (.+), who left", got[i])[1]
        assert not set(re.findall(r"\w{3,}", n.partition(" ")[2])) & set(re.findall(r"\w{3,}", inside)), inside
    assert got[0].replace("Mrs. ", "") == got[5].replace("Dr ", "")


def test_names_without_a_form_of_address(spark):
    rows = [
        (1, "Erika Mustermann came. Mrs Erika Mustermann left; Mustermann’s car, Mustermanns and x@y.example.com: Erika Mustermann"),
        (2, "Mr Smith and Mrs Mary Smith: Smith, Mary Smith, Blacksmith, smith"),
        (3, "Mustermann and Smith are not named here, a@b.example.com"),
        (4, "Dr. Jan van der Berg. van der Berg, Berg, Bergen"),
    ]
    got = {r["doc_id"]: r["text"] for r in replace_personal_data(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    lady = re.search(r"Mrs (\w+ (\w+)) left", got[1])
    assert re.fullmatch(rf"{lady[1]} came\. Mrs {lady[1]} left; {lady[2]}’s car, Mustermanns and \S+: {lady[1]}", got[1])
    man, woman = re.match(r"Mr (\w+) and Mrs (\w+ \w+): ", got[2]).groups()
    assert got[2].partition(": ")[2] == f"{man}, {woman}, Blacksmith, smith" and woman != man
    assert got[3].startswith("Mustermann and Smith are not named here, ")
    assert re.fullmatch(r"Dr\. (\w+ (\w+))\. van der \2, \2, Bergen", got[4])


def test_long_addresses_of_hosts(spark):
    values = ["2001:db8:85a3::8a2e:370:7334", "2001:0DB8:0:0:0:0:0:1", "fe80::1"]
    shape = lambda t: re.sub("[a-fA-F]", "a", re.sub(r"\d", "0", t))
    plain = ["std::cout", "a::b", "12:30:45", "10:20", "abc::def", "::", "x2001:db8::1"]
    rows = [(i, f"at {v}, then") for i, v in enumerate(values + plain)]
    got = {r["doc_id"]: r["text"] for r in replace_personal_data(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, v in enumerate(values):
        made = re.fullmatch(r"at (\S+), then", got[i])[1]
        assert made != v and shape(made) == shape(v)
    assert all(got[len(values) + i] == f"at {v}, then" for i, v in enumerate(plain))

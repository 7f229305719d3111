from moodlens.functions.porter import stem

# Examples from the published description of the algorithm.
CASES = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "hopefulness": "hope", "formaliti": "formal", "triplicate": "triplic", "formative": "form",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "communism": "commun",
    "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "generalizations": "gener", "oscillators": "oscil",
}


def test_porter_published_examples():
    for word, want in CASES.items():
        assert stem(word) == want, word


def test_stem_udf_keeps_shape(spark):
    from moodlens.operators.stem import stem_tokens

    df = spark.createDataFrame([(1, ["Running", "cats"]), (2, []), (3, None)], "id int, t array<string>")
    got = {r["id"]: r["s"] for r in df.select("id", stem_tokens("t").alias("s")).collect()}
    assert got == {1: ["run", "cat"], 2: [], 3: None}

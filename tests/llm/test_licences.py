import re

from goldrec.llm import licences
from llm.conftest import found

BASE = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for p, label in BASE.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_equals_brute_force(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = licences.scan(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        for label, phrase in (("apache-2.0", "Apache License, Version 2.0"), ("cc-by-nc-4.0", "CC BY-NC 4.0"), ("gpl-3.0", "GNU General Public License")):
            assert (label in r["labels"].split(",")) == (phrase in text[r["doc_id"]])


def test_needs_rare_words_in_place_and_the_key_phrase(spark):
    notice = licences.NOTICES["mit"][0]
    words = notice.split()
    texts = ["So: " + notice.upper() + ".", " ".join(reversed(words)), notice.replace("hereby", "now"), "x " * 500 + notice, "cc cc by by", None, "", "CC-BY cc by"]
    rows = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i]["labels"] for i in range(8)] == ["mit", "", "", "mit", "cc-by", "", "", "cc-by"]
    assert (rows[4]["first_word"], rows[7]["n_base"], rows[7]["last_word"], rows[5]["n_words"], rows[5]["score"]) == (1, 2, 2, 0, 0)


def test_odd_rows(odd, clashing, empty):
    rows = found(licences.scan(odd))
    assert len(rows) == 13 and [r[5] for r in rows if r[0] == 10] == ["cc-by,reserved"]
    assert found(licences.scan(clashing)) == rows
    assert licences.scan(empty).collect() == []

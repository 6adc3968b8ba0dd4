import hashlib

import numpy as np
import pytest

from goldrec.llm import omh
from llm.conftest import found


def test_order_of_blocks_tells():
    rng = np.random.default_rng(0)
    a, b = ("".join(rng.choice(list("abcdefgh"), 2_000)) for _ in range(2))
    same, swapped, other = omh.signature(a + b), omh.signature(b + a), omh.signature(b[::-1] + a[::-1])
    few = omh.signature(a[:1_000] + "x" + a[1_000:] + b)
    assert omh.likeness(same, few) > 0.9 > omh.likeness(same, swapped) > omh.likeness(same, other)
    assert omh.likeness(omh.signature(""), omh.signature("")) == 1 and omh.likeness(omh.signature(""), same) == 0


@pytest.mark.parametrize("bucket", [1_000, 7])
def test_edits_follow_the_next_document(documents, monkeypatch, bucket):
    monkeypatch.setattr(omh, "BUCKET_ROWS", bucket)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    ids = sorted(texts, reverse=True)
    rows = omh.edit_likeness(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    for r in rows:
        own, after = texts[r["doc_id"]], texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        cut = len(own) // 3
        edited = own[:len(own) - cut] + after[:cut]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == omh.signature(own) and r["edited_fingerprint"] == omh.signature(edited)
        assert r["near_edited"] == omh.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == omh.likeness(r["fingerprint"], omh.signature(after))
    assert np.mean([r["near_edited"] for r in rows]) > np.mean([r["near_next"] for r in rows]) + 0.1


def test_odd_rows(spark, odd, clashing, empty):
    rows = found(omh.edit_likeness(odd))
    assert len(rows) == 13
    assert len({r[3] for r in rows if r[0] in (4, 5)}) == 1
    assert found(omh.edit_likeness(clashing)) == rows
    assert omh.edit_likeness(empty).collect() == []
    one = omh.edit_likeness(spark.createDataFrame([(1, "alone here")], "doc_id int, text string")).first()
    assert one["near_next"] == 1 and one["n_chars"] == 10
    assert found(omh.fingerprints(odd)) == sorted(((r[0], r[3]) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_likeness_doesnt_turn_at_a_number_of_kmers():
    """1,024 and 1,025 k-mers, one inserted character apart; so are 1,023 and 1,024."""
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh"), 1_025 + omh.K - 1))
    for n in (1_023, 1_024):
        one = text[:n + omh.K - 1]
        other = one[:500] + "x" + one[500:]
        assert omh.likeness(omh.signature(one), omh.signature(other)) > 0.8


def brute_signature(text, k=omh.K, bits=omh.BITS, take=omh.TAKE):
    """Occurrence by occurrence, bin by bin, with the module's hash of a k-mer."""
    if not text:
        return omh.BLANK * (1 << bits)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    size, mask = min(k, len(points)), 2**64 - 1
    seen, bins = {}, [[] for _ in range(1 << bits)]
    for i in range(len(points) - size + 1):
        h = int(omh.kmer_hashes(points[i:i + size], size)[0])
        nth = seen[h] = seen.get(h, -1) + 1
        value = int(omh._mix(np.array([(h * 0x9E3779B97F4A7C15 + nth * 0xC2B2AE3D27D4EB4F) & mask], np.uint64))[0])
        bins[value >> (64 - bits)].append((value, i))
    out = []
    for found_ in bins:
        names = [x[0] for x in sorted(sorted(found_)[:take], key=lambda x: x[1])]
        digest = 0
        for name in names + [0] * (take - len(names)):
            digest = int(omh._mix(np.array([(digest * 0xFF51AFD7ED558CCD + name + 1) & mask], np.uint64))[0])
        out.append(f"{digest >> 32:08x}" if names else omh.BLANK)
    return "".join(out)


@pytest.mark.parametrize("text", ["", "a", "abc", "aaaaaaaaaaaaaaaaaaaa", "the cat " * 40, "é漢🙂" * 30, "".join(chr(97 + i * i % 26) for i in range(900))])
def test_equals_brute_force(text):
    assert omh.signature(text) == brute_signature(text)

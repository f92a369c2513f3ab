"""Fixity audit and token files."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from relist.llm.fixity import Fixity, audit, records
from relist.llm.token_scan import TokenScan, document_lengths, token_counts
from tests.llm.cases import frame, odd_rows, prose

PAGES = "page_id bigint, url string, html string, node bigint, hash string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "h") for r in rows], PAGES)


def page_rows():
    rows = [(k, f"http://h{k}.example/", f"<p>{prose(k, 5 + k % 50)}</p>") for k in range(400)]
    return rows + [(None, "u", "<p>nameless</p>"), (None, None, None), (7, None, ""), (900, "again", "<p>same</p>"), (900, "again", "<p>same</p>")]


SMALL = Fixity(pages_per_file=20, range_bytes=2_000, fan_out=3)


def record(url, html):
    body = html or ""
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n".encode()


def test_offsets_lie_one_behind_another(spark):
    found = records(pages(spark, page_rows()), SMALL).collect()
    for file in {r.file for r in found}:
        end = 0
        for r in sorted((r for r in found if r.file == file), key=lambda r: r.offset):
            assert r.offset == end
            end += r.length * r.copies
    digests = {r.sha256 for r in found}
    assert digests == {hashlib.sha256(record(u, h)).hexdigest() for _, u, h in page_rows()}


def test_audit_finds_exactly_the_damage(spark):
    """Changed, longer, lost and inserted records, in the middle and at the end of files: one row each, none for those that only moved."""
    sound = page_rows()
    hurt = [(i, u, "#" + h[1:] if i in (3, 99, 250) and h else h + "!!" if i in (41, 260) and h else h) for i, u, h in sound if i not in (39, 65, 399)]
    hurt += [(19, "new", "<p>more</p>"), (108, "new", "<p>more</p>"), (None, "w", "<p>other</p>")]
    found = audit(pages(spark, sound), pages(spark, hurt), SMALL).collect()
    want = {(i, "changed") for i in (3, 99, 250, 41, 260)} | {(i, "missing") for i in (39, 65, 399)} | {(19, "extra"), (108, "extra"), (None, "extra")}
    assert {(r.page_id, r.kind) for r in found} == want and len(found) == len(want)
    text = {i: (u, h) for i, u, h in sound}
    for r in found:
        if r.kind != "extra":
            assert r.expected_sha256 == hashlib.sha256(record(*text[r.page_id])).hexdigest() != r.found_sha256
    before = {(r.file, r.offset, r.sha256) for r in records(pages(spark, sound), SMALL).collect()}
    after = {(r.file, r.offset, r.sha256) for r in records(pages(spark, hurt), SMALL).collect()}
    assert all((r.file, r.offset, r.expected_sha256) in before if r.kind != "extra" else (r.file, r.offset, r.found_sha256) in after for r in found)
    several = [(5, "a", "1"), (5, "b", "2"), (5, "c", "3")]
    kinds = [r.kind for r in audit(pages(spark, several), pages(spark, [(5, "b", "2"), (5, "d", "4")]), SMALL).collect()]
    assert sorted(kinds) == ["changed", "missing"]


def test_audit_of_equal_empty_and_copied_rows(spark):
    sound = pages(spark, page_rows())
    assert audit(sound, sound.repartition(3), SMALL).count() == 0
    assert audit(pages(spark, []), pages(spark, [])).count() == 0
    assert {r.kind for r in audit(sound, pages(spark, []), SMALL).collect()} == {"missing"}
    lost_copy = audit(sound, pages(spark, page_rows()[:-1]), SMALL).collect()
    assert [(r.page_id, r.kind) for r in lost_copy] == [(900, "changed")]


def plain_lengths(tokens):
    found, start = [], 0
    for place, token in enumerate(tokens):
        if token == 0:
            found.append((start, place - start, True))
            start = place + 1
    if start < len(tokens):
        found.append((start, len(tokens) - start, False))
    return found


def test_scan_stitches_blocks(spark, tmp_path):
    draw = np.random.default_rng(3)
    files = {
        "part-0": draw.integers(0, 9, 4001), "part-1": np.zeros(10, int), "part-2": np.ones(5000, int), "part-3": np.array([256, 1, 0, 2]),
        "part-4": np.concatenate([np.ones(1023, int), [0], np.ones(1024, int), [0]]), "part-5": np.array([], int),
    }
    for name, tokens in files.items():
        (tmp_path / name).write_bytes(tokens.astype("<u2").tobytes())
    for block in (2, 64, 2048, 1 << 20):
        found = document_lengths(spark, str(tmp_path), TokenScan(head=3, block_bytes=block)).collect() if block > 2 else []
        for name, tokens in files.items():
            own = sorted((r for r in found if r.path.endswith(name)), key=lambda r: r.document)
            if block > 2:
                assert [(r.start, r.tokens, r.closed) for r in own] == plain_lengths(tokens)
                assert [r.document for r in own] == list(range(len(own)))
                assert all(r.head == tokens[r.start : r.start + min(3, r.tokens)].tolist() for r in own)


def test_token_counts_of_odd_rows(spark):
    rows = [*odd_rows(), (-5, "minus five words are here"), (2**62, "a b")]
    found = token_counts(frame(spark, rows), TokenScan(block_bytes=128)).collect()
    assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in found))) == sorted(map(str, ((i, len((t or "").split())) for i, t in rows)))
    assert token_counts(frame(spark, [])).agg(F.count("*")).first()[0] == 0

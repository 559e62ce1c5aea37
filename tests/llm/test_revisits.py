"""Revisit links with repeated page ids."""

import hashlib

import fixtures
from test_warc import frame

from firstlight.llm import warc


def test_one_page_id_with_two_payloads(spark):
    one, two, alone = "a" * 1500, "b" * 1500, "c" * 1500
    rows = [(1, "u", one), (1, "u", two), (1, "u", alone), (5, "u", one), (6, "u", two)]
    got = warc.round_trip(frame(spark, rows))
    digest = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = [(1, digest(one), "revisit", 5), (1, digest(two), "revisit", 6), (1, digest(alone), "response", None)]
    want += [(5, digest(one), "response", None), (6, digest(two), "response", None)]
    assert fixtures.rows_of(got, "page_id", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)

"""What the splitter computes once stays."""

import fixtures

from firstlight.llm import pretokens


def test_power_tables_are_made_once():
    splitter = pretokens.Splitter(pretokens.load(fixtures.path("byte_bpe_50k.json"))[0])
    first = splitter.spans(["river stone", "ox"])
    tables = splitter._power
    again = splitter.spans(["river stone", "ox"])
    assert splitter._power is tables
    assert (again.keys == first.keys).all()

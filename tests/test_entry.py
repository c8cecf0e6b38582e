"""Driver contract: query and oracle registries line up."""

import re

import __spark_entry__ as E


def test_registries_line_up():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # Every query has an oracle but those of the optional subpackage that SQL cannot express.
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(qs) - set(sql))

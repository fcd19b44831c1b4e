"""Named jobs over the test tables: ``queries()`` and their SQL oracles."""

"""The library applied to the test tables, with the SQL that gives the same results."""

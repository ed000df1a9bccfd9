"""The registered queries, each with the SQL it is compared with."""

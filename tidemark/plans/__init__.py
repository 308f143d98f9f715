"""The registered queries, each next to the SQL it is compared with."""

"""DataFrame operators: grouped averages, ordering and row index, delimited
parsing, SQL reports, table sinks, person/account profiles and predicates,
keyed aggregates and lookups, partitioning helpers."""

"""The star-schema test tables seen as raw claims data, the registered queries over them, and their SQL twins."""

"""The tables: bronze to silver to marts, summaries, registries and reports."""

"""Import every catalog module so that all queries are registered."""

from tessera.plans import catalog_corpus, catalog_dense, catalog_lexical, catalog_lm, catalog_store  # noqa: F401

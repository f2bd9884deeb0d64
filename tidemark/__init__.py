"""tidemark: paged web-service responses to audited bronze pages and typed silver tables, on Spark."""

"""End-to-end plans and the catalogue of registered queries with their SQL counterparts."""

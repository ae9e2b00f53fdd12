"""Plan-level helpers: size-checked broadcast, stage materialisation, the query catalog and the
end-to-end pipeline runner."""

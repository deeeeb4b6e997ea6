"""Pages and script bundles to rows: small row helpers behind Arrow-batched functions."""

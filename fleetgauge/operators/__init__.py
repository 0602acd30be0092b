"""DataFrame-to-DataFrame operators; each works on batch tables and, unless it says otherwise, on streams."""

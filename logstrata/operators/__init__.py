"""DataFrame to DataFrame operators: framing, formats, classification, catalogue, shards, corpus reads."""

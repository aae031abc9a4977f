"""Column-level steps: message codec, time stamps, money."""

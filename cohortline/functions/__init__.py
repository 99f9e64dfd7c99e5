"""Column builders: URL host, policy and visit keys, dates, channel rules, lifecycle flags."""

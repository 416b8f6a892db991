"""Sources: feed registry, page envelopes, incremental cut, driver-table fixtures."""

"""Learning-log analytics on Spark: sessions, answer reports, leaderboards,
topic relays, wide-column scans and keyed collections as DataFrame jobs."""

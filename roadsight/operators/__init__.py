"""DataFrame operators: cleaning, features, selection, marts, KPIs, top-k,
tracking, clustering, and the skew-safe sequence helpers they share."""

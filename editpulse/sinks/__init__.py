"""Writers: stored tables and their layout, views, descriptions, JDBC landing."""

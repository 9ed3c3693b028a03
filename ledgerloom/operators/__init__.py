"""DataFrame operators over the register's tables."""

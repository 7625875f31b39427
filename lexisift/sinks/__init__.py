"""Writers: category lines, statistics, token CSV and term lists."""

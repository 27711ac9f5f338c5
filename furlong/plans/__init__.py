"""Plan helpers: oracle SQL texts and physical-plan inspection."""

"""Physical layout and plan inspection."""

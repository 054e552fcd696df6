"""Column expressions: calendar, solar position, tariffs, plant physics, dispatch rules, profiles."""
